"""Claims, facts and entities of a stored graph.

Nodes come as tables of their own, edges as (src, dst).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.functions import ids
from finloom.operators.dedup import first_wins
from finloom.storage import spread

# Ratings and the sentiment that they express; others are neutral.
SENTIMENTS: Mapping[str, str] = {
    "Buy": "bullish",
    "Overweight": "bullish",
    "Outperform": "bullish",
    "Hold": "neutral",
    "Neutral": "neutral",
    "Equal-weight": "neutral",
    "Sell": "bearish",
    "Underweight": "bearish",
    "Underperform": "bearish",
}


def analyst_name(content: Column) -> Column:
    """Who a claim ``<name> rates ...`` is from; null for other claims."""
    return F.nullif(F.trim(F.regexp_extract(content, r"^([A-Z][A-Za-z&./\s]+?)\s+rates\s+", 1)), F.lit(""))


def rating_sentiment(rating: Column) -> Column:
    out = F.lit("neutral")
    for name, sentiment in SENTIMENTS.items():
        out = F.when(rating == name, sentiment).otherwise(out)
    return out


def rated_claims(claims: DataFrame, about: DataFrame, entities: DataFrame, made: DataFrame) -> DataFrame:
    """Claims (claim_id, rating, target_price, content) with a rating or a price,
    once for each of their entities (about: src claim, dst entity; entities:
    entity_id, name) and sources (made: src source, dst claim), null without one."""
    rated = claims.where(F.col("rating").isNotNull() | F.col("target_price").isNotNull())
    named = about.join(entities, F.col("dst") == F.col("entity_id")).select(F.col("src").alias("claim_id"), "entity_id", F.col("name").alias("entity_name"))
    sourced = made.select(F.col("dst").alias("claim_id"), F.col("src").alias("source_id"))
    return rated.join(named, "claim_id", "left").join(sourced, "claim_id", "left")


def stance_backfill(rated: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Authors (id, name), stances (id, rating, sentiment, target_price, author,
    entity) and edges (src, dst, type) of rated claims whose analyst and entity
    are known.  Stances aren't dated, so a claim of the same analyst on the same
    entity has the same stance id."""
    analyst = analyst_name(F.coalesce("content", F.lit("")))
    known = rated.withColumn("author", analyst).where(F.col("author").isNotNull() & (F.coalesce("entity_name", F.lit("")) != "") & F.col("entity_id").isNotNull())
    known = known.withColumn("author_id", ids.keyed_id("author", F.col("author"), F.lit("sell_side")))
    known = known.withColumn("stance_id", ids.keyed_id("stance", F.col("author"), F.col("entity_name"), F.lit("")))
    edge = lambda src, dst, kind: known.select(F.col(src).cast("string").alias("src"), F.col(dst).cast("string").alias("dst"), F.lit(kind).alias("type")).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    edges = edge("author_id", "stance_id", "HOLDS_STANCE").unionByName(edge("stance_id", "entity_id", "ON_ENTITY"))
    edges = edges.unionByName(edge("stance_id", "claim_id", "BASED_ON")).unionByName(edge("source_id", "author_id", "AUTHORED_BY"))
    stances = known.select(
        F.col("stance_id").alias("id"), "rating", rating_sentiment(F.coalesce("rating", F.lit(""))).alias("sentiment"), "target_price", "author", F.col("entity_name").alias("entity")
    )
    return known.select(F.col("author_id").alias("id"), F.col("author").alias("name")).distinct(), stances.distinct(), edges.distinct()


def claims_to_classify(claims: DataFrame, made: DataFrame, sources: DataFrame, about: DataFrame, entities: DataFrame, resume: bool = False) -> DataFrame:
    """claim_id, content, source_title, source_type and the distinct names of its
    entities (in order), once a claim: with the source collected last.  With
    ``resume`` claims that already have a type but ``analysis`` are left out."""
    wanted = claims.where(F.coalesce(F.col("claim_type") == "analysis", F.lit(True))) if resume else claims
    named = about.join(entities, F.col("dst") == F.col("entity_id")).groupBy(F.col("src").alias("claim_id")).agg(F.array_sort(F.collect_set("name")).alias("entity_names"))
    of_source = made.join(sources, F.col("src") == F.col("source_id")).select(F.col("dst").alias("claim_id"), "title", "source_type", "collected_at", "source_id")
    latest = of_source.groupBy("claim_id").agg(F.max_by(F.struct("title", "source_type"), F.struct("collected_at", "source_id")).alias("s"))
    return (
        wanted.join(spread(latest), "claim_id")
        .join(named, "claim_id", "left")
        .select(
            "claim_id", F.coalesce("content", F.lit("")).alias("content"), F.coalesce("s.title", F.lit("")).alias("source_title"),
            F.coalesce("s.source_type", F.lit("")).alias("source_type"), F.coalesce("entity_names", F.array().cast("array<string>")).alias("entity_names"),
        )
    )


def classified(claims: DataFrame, results: DataFrame) -> DataFrame:
    """Claims with the type, sentiment and magnitude of the results of their id;
    results of unknown claims change nothing, of repeated ones the largest counts."""
    fields = ("claim_type", "sentiment", "magnitude")
    new = results.groupBy("claim_id").agg(F.max(F.struct(*fields)).alias("new"))
    joined = claims.join(spread(new), "claim_id", "left")
    changed = F.col("new").isNotNull()
    return joined.select(*[F.when(changed, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in claims.columns])


def sampled_facts(facts: DataFrame, claims: DataFrame, stated: DataFrame, contained: DataFrame, sources: DataFrame, n: int, seed: str) -> DataFrame:
    """n facts and claims (id, content) with their source, the same for the same
    seed: a sampling operator.  stated: src chunk, dst fact or claim; contained:
    src source, dst chunk; sources: source_id, title, url."""
    every = facts.select("id", "content", F.lit("Fact").alias("label")).unionByName(claims.select("id", "content", F.lit("Claim").alias("label")))
    picked = every.where(F.col("content").isNotNull()).withColumn("h", F.md5(F.concat_ws("|", F.lit(seed), "label", F.col("id").cast("string")))).orderBy("h", "id").limit(n)
    chunk = stated.groupBy(F.col("dst").alias("id")).agg(F.min("src").alias("chunk"))
    source = contained.groupBy(F.col("dst").alias("chunk")).agg(F.min("src").alias("source_id"))
    return picked.drop("h").join(chunk, "id", "left").join(source, "chunk", "left").join(sources, "source_id", "left").select("id", "content", "label", "title", "url")


def entity_context(entities: DataFrame, related: DataFrame, facts: DataFrame, points: DataFrame, claims: DataFrame, most: int | None = None) -> DataFrame:
    """For every entity (id) at once the numbers of facts, data points and claims
    that lead to it, and the contents of ``most`` of each, in order.

    related: src (a fact, data point or claim), dst (an entity); facts and
    claims: id, content (empty ones don't count); points: id, metric_name, value.
    Without ``most`` no contents are gathered.
    """
    def of(rows: DataFrame, text: Column, name: str) -> DataFrame:
        met = rows.select(F.col("id").alias("src"), text.alias("text")).where(F.coalesce(F.col("text") != "", F.lit(False)))
        met = related.join(met, "src").select(F.col("dst").alias("id"), "text")
        counted = met.groupBy("id").agg(F.count("*").alias(f"n_{name}"))
        if most is None:
            return counted
        from finloom.operators.dedup import keep_newest

        kept = keep_newest(met, ["id"], [F.col("text")], most).groupBy("id").agg(F.array_sort(F.collect_list("text")).alias(name))
        return counted.join(kept, "id")

    out = entities.select("id")
    for rows, text, name in ((facts, F.col("content"), "facts"), (points, F.concat_ws("=", "metric_name", F.col("value").cast("string")), "datapoints"), (claims, F.col("content"), "claims")):
        out = out.join(of(rows, text, name), "id", "left").withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0)).cast("long"))
    return out


def with_missing_ids(entities: DataFrame) -> DataFrame:
    """Entities (node, name, entity_type, entity_id, entity_key) where those
    without an id take one from name and type, unless another node has that key;
    of several such nodes the first (by node) does.  ``fixed`` tells which."""
    kind = F.coalesce(F.nullif("entity_type", F.lit("")), F.lit("unknown"))
    key = F.concat_ws("::", "name", kind)
    missing = entities.where(F.col("entity_id").isNull() & F.col("name").isNotNull()).withColumn("new_key", key)
    held = entities.where(F.col("entity_key").isNotNull()).select(F.col("entity_key").alias("new_key"), F.col("node").alias("holder"))
    taken = missing.join(held, "new_key").where(F.col("holder") != F.col("node")).select("node").distinct()
    free = first_wins(missing.join(taken, "node", "left_anti").select("node", "new_key"), ["new_key"], ["node"])
    joined = entities.join(free, "node", "left").withColumn("fixed", F.col("new_key").isNotNull())
    new_id = ids.keyed_id("entity", F.col("name"), kind)
    return joined.select(
        "node", "name", "entity_type", F.when(F.col("fixed"), new_id).otherwise(F.col("entity_id")).alias("entity_id"), F.coalesce("new_key", "entity_key").alias("entity_key"), "fixed"
    )


def label_scan(nodes: DataFrame, label: str, without: tuple[str, ...] = ("Memory", "Archived")) -> DataFrame:
    """Nodes (labels: array) of a label that have none of the labels ``without``."""
    return nodes.where(F.array_contains("labels", label) & ~F.arrays_overlap("labels", F.array(*map(F.lit, without))))


def edges_with_ends(edges: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """Edges with the ``key`` of both ends; an edge without one of its nodes is left out."""
    src, dst = (nodes.select(F.col("id").alias(end), F.col(key).alias(f"{end}_{key}")) for end in ("src", "dst"))
    return edges.join(src, "src").join(dst, "dst")


def contaminated(nodes: DataFrame, one: tuple[str, ...], other: tuple[str, ...]) -> DataFrame:
    """Nodes that have labels of both of two kinds that must stay apart."""
    has = lambda names: F.arrays_overlap("labels", F.array(*map(F.lit, names)))
    return nodes.where(has(one) & has(other))


def merge_edges(edges: DataFrame, changes: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Edges (src, dst, type and properties) after a merge: a change sets the
    properties of the edge of its ends and type, or makes it.  Of repeated
    changes the last by ``order`` counts."""
    key = ("src", "dst", "type")
    others = [c for c in edges.columns if c not in key]
    last = F.struct(*order, *others) if order else F.struct(*others)
    new = changes.groupBy(*key).agg(F.max(last).alias("new"))
    joined = edges.withColumn("had", F.lit(True)).join(new, list(key), "full_outer")
    changed = F.col("new").isNotNull()
    return joined.select(*key, *[F.when(changed, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in others])


def path_references(components: DataFrame) -> DataFrame:
    """Edges (src, dst) from components (id, content) to those that their content
    names by path ``.claude/<kind>s/<slug>``; a slug that ends with a hyphen is a
    pattern and no reference."""
    path = r"\.claude/(agents|commands|skills|rules)/([a-zA-Z0-9][-a-zA-Z0-9_]*)"
    found = components.select(F.col("id").alias("src"), F.explode(F.expr(f"regexp_extract_all(content, r'({path})', 1)")).alias("path"))
    kind, slug = F.regexp_extract("path", path, 1), F.regexp_extract("path", path, 2)
    edges = found.where(~slug.endswith("-")).select("src", F.concat(F.substring(kind, F.lit(1), F.length(kind) - 1), F.lit(":"), slug).alias("dst"))
    return edges.distinct()


def shown_components(components: DataFrame, types: tuple[str, ...] = (), categories: tuple[str, ...] = (), matched: DataFrame | None = None) -> DataFrame:
    """Components (id, type, category) of the types and, if categories are given,
    the agents of these, that a search (matched: id) found; nothing given filters nothing."""
    out = components
    if types:
        out = out.where(F.col("type").isin(*types))
    if categories:
        out = out.where((F.col("type") == "agent") & F.col("category").isin(*categories))
    return out if matched is None else out.join(matched.select("id"), "id", "left_semi")


def drawn(components: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a drawing of the graph shows: edges (src, dst, broken) between known
    components that aren't broken, and the components that they touch."""
    known = components.select("id")
    kept = edges.where(~F.col("broken")).join(known.withColumnRenamed("id", "src"), "src", "left_semi").join(known.withColumnRenamed("id", "dst"), "dst", "left_semi")
    ends = kept.select(F.col("src").alias("id")).unionByName(kept.select(F.col("dst").alias("id"))).distinct()
    return components.join(ends, "id", "left_semi"), kept


def package_edges(imports: DataFrame, packages: tuple[str, ...]) -> DataFrame:
    """Distinct edges (src, dst) between packages by the import lines of their
    files (package, content); imports of one's own package are left out."""
    line = r"(?m)^\s*(?:from|import)\s+([A-Za-z_]\w*)"
    found = imports.select(F.col("package").alias("src"), F.explode(F.expr(f"regexp_extract_all(content, r'{line}', 1)")).alias("dst"))
    return found.where(F.col("dst").isin(*packages) & (F.col("src") != F.col("dst"))).distinct()
