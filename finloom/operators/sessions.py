"""Preparing sessions: themes, duplicates against what is known, checks of plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.functions import text, url
from finloom.operators.dedup import keep_newest
from finloom.storage import spread

_URL = r"https?://[^\s)\]>\"']+"


def urls_in(body: Column, without: str = "github.com") -> Column:
    """Normalised URLs of a text, but for those of one site."""
    found = F.regexp_extract_all(body, F.lit(f"({_URL})"), F.lit(1))
    kept = F.filter(found, lambda u: ~url.host_in(u, [without]))
    return F.array_distinct(F.transform(kept, lambda u: url.normalize_url(u)))


def theme_items(items: DataFrame, themes: DataFrame, n: int) -> DataFrame:
    """theme, item_id and at: per theme the newest n of its source's items that
    hold one of its keywords; n of 0 or less keeps all.

    themes: theme, source, keywords (array); items: item_id, source, text, at.
    """
    met = items.join(themes, "source")
    low = F.lower("text")
    found = met.where(F.exists("keywords", lambda k: F.contains(low, F.lower(k)))).select("theme", "item_id", "at")
    return found if n <= 0 else keep_newest(found, ["theme"], [F.col("at").desc_nulls_last(), F.col("item_id")], n)


def known_duplicates(new: DataFrame, known: DataFrame, threshold: float = 0.85) -> DataFrame:
    """new_id, known_id and reason: the first known item (by pos) with the URL of a
    new one, or a title with ``threshold`` of its words.

    new: id, url, title; known: pos, id, url, title.  URLs join on their normal
    form; titles join on their rarest words, as similar ones share one of them.
    """
    from finloom.operators.similarity import similar_sets

    a = new.select("id", url.normalize_url(F.col("url")).alias("normal"), F.array_sort(text.word_set(F.coalesce("title", F.lit("")))).alias("words"))
    b = known.select("pos", F.col("id").alias("known_id"), url.normalize_url(F.col("url")).alias("normal"), F.array_sort(text.word_set(F.coalesce("title", F.lit("")))).alias("words"))
    # One known item a URL or title is enough: that which comes first.
    first_known = F.min(F.struct("pos", "known_id")).alias("k")
    of_url = b.groupBy("normal").agg(first_known).select("normal", "k.*")
    by_url = a.where("normal <> ''").join(spread(of_url), "normal").select("id", "pos", "known_id", F.lit("url").alias("reason"))
    key = lambda: F.xxhash64("words")
    sets = a.select("words").unionByName(b.select("words")).where(F.size("words") > 0).distinct().withColumn("set", key())
    pairs = similar_sets(sets, "set", "words", threshold).select("a", "b")
    same = sets.select(F.col("set").alias("a"), F.col("set").alias("b"))
    linked = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(same)
    theirs = b.groupBy(key().alias("b")).agg(first_known).select("b", "k.*")
    of_title = linked.join(theirs, "b").groupBy("a").agg(first_known).select("a", "k.*")
    by_title = a.select("id", key().alias("a")).join(spread(of_title), "a").select("id", "pos", "known_id", F.lit("title").alias("reason"))
    # Of one known item the URL is the reason that is found first.
    both = by_url.unionByName(by_title)
    first = F.min(F.struct("pos", F.when(F.col("reason") == "url", 0).otherwise(1).alias("rank"), "known_id", "reason")).alias("m")
    return both.groupBy("id").agg(first).select(F.col("id").alias("new_id"), "m.known_id", "m.reason")


def publish_status(articles: DataFrame, published: DataFrame) -> DataFrame:
    """url and status: skipped without a summary, duplicate if published, else success."""
    done = published.select(url.normalize_url(F.col("url")).alias("normal"), F.lit(True).alias("done")).distinct()
    joined = articles.withColumn("normal", url.normalize_url(F.col("url"))).join(done, "normal", "left")
    blank = F.coalesce(F.trim("summary") == "", F.lit(True))
    return joined.select("url", F.when(blank, "skipped").when(F.col("done"), "duplicate").otherwise("success").alias("status"))


def priority_violations(tasks: DataFrame, order: Sequence[str] = ("low", "medium", "high")) -> DataFrame:
    """Tasks (id, priority, depends_on) with a higher priority than one they need;
    an unknown priority is medium."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col("priority")), F.lit(0)), F.lit(2))
    ranked = tasks.select("id", rank.alias("rank"), "depends_on")
    need = ranked.select(F.col("id").alias("dep"), F.col("rank").alias("dep_rank"))
    flat = ranked.select("id", "rank", F.explode("depends_on").alias("dep"))
    return flat.join(need, "dep", "left").where(F.col("rank") > F.coalesce("dep_rank", F.lit(2))).select("id", "dep")


def entry_errors(presets: DataFrame) -> DataFrame:
    """Presets with the list of what is wrong with them (url, title, category)."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    problems = F.array_compact(
        F.array(
            F.when(blank("url"), "url is missing").when(~url.is_web_url(F.col("url")), "url is not a web address"),
            F.when(blank("title"), "title is missing"),
            F.when(blank("category"), "category is missing"),
        )
    )
    return presets.withColumn("errors", problems)


def preset_problems(entries: DataFrame, content: str, intervals: Sequence[str]) -> DataFrame:
    """Presets as JSON objects with what is wrong with them (errors) or odd
    (warnings): required fields, web address, types and known intervals."""
    kind = F.schema_of_variant
    v = F.try_parse_json(content)
    of = lambda name: F.try_variant_get(v, f"$.{name}", "string")
    typed = lambda name: kind(F.try_variant_get(v, f"$.{name}", "variant"))
    scheme, host = F.lower(F.regexp_extract(F.coalesce(of("url"), F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)), url.host(F.coalesce(of("url"), F.lit("")))
    given = F.coalesce(of("url"), F.lit("")) != ""
    errors = F.array_compact(F.array(
        F.when(v.isNull() | ~F.coalesce(kind(v).startswith("OBJECT"), F.lit(False)), "not an object"),
        *[F.when(typed(c).isNull(), f"{c} is missing") for c in ("url", "title", "category")],
        F.when(given & ~scheme.isin("http", "https"), "scheme is not http or https"), F.when(given & (host == ""), "no host"), F.when(~given, "url is empty"),
        F.when(typed("enabled").isNotNull() & ~typed("enabled").isin("BOOLEAN", "VOID"), "enabled is not a boolean"),
    ))
    warnings = F.array_compact(F.array(
        F.when((F.coalesce(of("fetch_interval"), F.lit("")) != "") & ~of("fetch_interval").isin(*intervals), "unknown interval"),
        F.when(typed("tier").isNotNull() & ~typed("tier").isin("BIGINT", "VOID"), "tier is not an integer"),
    ))
    return entries.select(*[c for c in entries.columns if c != content], of("url").alias("url"), errors.alias("errors"), warnings.alias("warnings"))


def fuzzy_search(items: DataFrame, query: str, weights: dict[str, float], threshold: float = 0.4, k: int = 20, tie: str | None = None) -> DataFrame:
    """The k best items by the weighted likeness of their fields to the query: 1
    where a field contains it, else the best Levenshtein similarity of a word.
    Ties go by the fields, then by the column ``tie``."""
    low = query.lower()
    total = sum(weights.values())

    def likeness(field: str) -> Column:
        words = F.filter(F.split(F.lower(F.coalesce(field, F.lit(""))), r"\W+"), lambda w: w != "")
        best = F.array_max(F.transform(words, lambda w: text.levenshtein_similarity(w, F.lit(low))))
        return F.when(F.contains(F.lower(F.coalesce(field, F.lit(""))), F.lit(low)), 1.0).otherwise(F.coalesce(best, F.lit(0.0)))

    score = sum((likeness(f) * w for f, w in weights.items()), F.lit(0.0)) / total
    return items.withColumn("score", F.round(score, 4)).where(F.col("score") >= threshold).orderBy(F.col("score").desc(), *weights, *([tie] if tie else [])).limit(k)


def run_statistics(runs: DataFrame) -> DataFrame:
    """One row of totals of runs (started_at, completed_at, sources: map to
    success_count, error_count, article_count); the rate of none is 1."""
    each = runs.select(
        (F.unix_timestamp("completed_at") - F.unix_timestamp("started_at")).alias("seconds"),
        *[F.aggregate(F.map_values("sources"), F.lit(0).cast("long"), (lambda n: lambda a, s: a + F.coalesce(s[n], F.lit(0)))(n)).alias(n) for n in ("success_count", "error_count", "article_count")],
    )
    s, e = F.coalesce(F.sum("success_count"), F.lit(0)), F.coalesce(F.sum("error_count"), F.lit(0))
    return each.agg(
        F.count("*").alias("runs"), s.alias("success"), e.alias("errors"), F.coalesce(F.sum("article_count"), F.lit(0)).alias("articles"),
        F.coalesce(F.round(F.avg("seconds"), 2), F.lit(0.0)).alias("mean_seconds"),
        F.when(s + e > 0, F.round(s / (s + e), 4)).otherwise(1.0).alias("rate"),
    )


def source_statistics(runs: DataFrame) -> DataFrame:
    """Totals of every source over all runs."""
    flat = runs.select(F.explode("sources").alias("source", "s"))
    return flat.groupBy("source").agg(*[F.sum(f"s.{n}").alias(n) for n in ("success_count", "error_count", "article_count")])


def quota_by_domain(pending: DataFrame, limit: int) -> DataFrame:
    """Rows of pending (domain, url, at) that a run takes: an equal share of
    ``limit`` for every domain, one at least, the oldest first."""
    n = pending.select("domain").distinct().count()
    return keep_newest(pending, ["domain"], [F.col("at"), F.col("url")], max(1, limit // max(1, n)))
