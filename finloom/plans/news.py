"""Feed, article and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions import ids, text, url
from finloom.functions.finance import reliability_score
from finloom.operators import dedup, grouping, similarity
from finloom.plans.catalog import query
from finloom.session import table
from finloom.sources import documents as sources

# Parameters of the bindings to the driver's tables.
CATEGORY_OF = {"click": "stock", "purchase": "macro", "signup": "sector", "view": "index"}
DEFAULT_CATEGORY = "finance"
TOPICS = (("license", ("license",)), ("the", ("the ",)), ("french", ("le ", "la ")), ("german", ("der ", "die ")))
KEYWORDS = ("the", "of", "and", "license", "that", "with", "for", "from", "le", "der", "los", "secret")
PRIORITY = ("the", "der")
INDICATORS = ("the ", "license", "que ")
BLOCKED = ("example.com", "example.org", "news.net")

_CATEGORY_SQL = (
    "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CATEGORY_OF.items()) + f" ELSE '{DEFAULT_CATEGORY}' END"
)
_P = "'^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#.*)?$'"
_DOMAIN = f"regexp_replace(lower(regexp_extract(url, {_P}, 2)), '^www\\.', '')"


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _hits(words, column="text") -> str:
    return f"list_filter({_list(words)}, lambda k: contains(lower({column}), k))"


def _category(column: str = "event_type"):
    out = F.lit(DEFAULT_CATEGORY)
    for k, v in CATEGORY_OF.items():
        out = F.when(F.col(column) == k, v).otherwise(out)
    return out


@query(f"""
SELECT {_CATEGORY_SQL} AS category, CAST(ts AS DATE) AS day, count(*) AS n_articles,
       count(DISTINCT user_id) AS n_sources, round(avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END), 4) AS success_rate
FROM events GROUP BY 1, 2""")
def news_group_by_category_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles by mapped category and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(_category().alias("category"), F.to_date("ts").alias("day"))
        .agg(
            F.count("*").alias("n_articles"),
            F.countDistinct("user_id").alias("n_sources"),
            F.round(F.avg((F.col("event_type") != "error").cast("double")), 4).alias("success_rate"),
        )
    )


@query(f"""
SELECT domain, count(*) AS total, count(*) FILTER (ok) AS success, count(*) FILTER (NOT ok) AS failed,
       round(100.0 * count(*) FILTER (ok) / count(*), 1) AS rate
FROM (SELECT {_DOMAIN} AS domain, length(html) >= 1500 AS ok FROM pages) GROUP BY 1""")
def domain_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction rate of every domain."""
    pages = table(spark, sf_dir, "pages")
    return grouping.rates(pages, [url.domain(F.col("url")).alias("domain")], F.length("html") >= 1500)


@query(f"SELECT event_id, {_CATEGORY_SQL} AS category FROM events WHERE {_CATEGORY_SQL} IN ('finance', 'macro')")
def status_filter_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose mapped category is wanted; unmapped ones count as finance."""
    return table(spark, sf_dir, "events").select("event_id", _category().alias("category")).where(F.col("category").isin("finance", "macro"))


@query("SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 25 OFFSET 10")
def feed_items_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of items: offset, then limit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return docs.orderBy(F.col("n_chars").desc_nulls_last(), "doc_id").offset(10).limit(25)


@query("""
SELECT doc_id, source, n_chars FROM documents WHERE contains(lower(text), 'the ') AND source < 'src5'
ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 20""")
def feed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best twenty matches of a query in some feeds."""
    found = table(spark, sf_dir, "documents").where(text.matches_query("The ", F.col("text")) & (F.col("source") < "src5"))
    return found.select("doc_id", "source", "n_chars").orderBy(F.col("n_chars").desc_nulls_last(), "doc_id").limit(20)


@query("""
SELECT d.doc_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 3 = 0 AND e.text = d.text)""")
def diff_new_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose text the known ones (doc_id divisible by 3) lack; repeats stay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return dedup.new_rows(docs, docs.where("doc_id % 3 = 0"), "digest").select("doc_id")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest, count(*) AS copies FROM documents GROUP BY text")
def session_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first item of every text, and how many there are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return docs.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


_NORMAL_SQL = f"""
SELECT page_id, url, concat(
    CASE WHEN length(scheme) > 0 THEN concat(lower(scheme), ':') ELSE '' END,
    CASE WHEN length(host) > 0 THEN concat('//', regexp_replace(lower(host), '^www\\.', '')) ELSE '' END,
    regexp_replace(path, '/index\\.html$', ''),
    CASE WHEN len(kept) > 0 THEN concat('?', array_to_string(kept, '&')) ELSE '' END) AS normal
FROM (SELECT *, flatten(list_transform(list_filter(names, lambda n, i: list_position(names, n) = i
        AND NOT (n LIKE 'utm\\_%' ESCAPE '\\' OR n LIKE 'guce\\_%' ESCAPE '\\' OR n IN ({', '.join(f"'{n}'" for n in url.TRACKING_NAMES)}))),
        lambda n: list_filter(pairs, lambda p: split_part(p, '=', 1) = n))) AS kept
  FROM (SELECT *, list_transform(pairs, lambda p: split_part(p, '=', 1)) AS names
    FROM (SELECT page_id, url, regexp_extract(u, {_P}, 1) AS scheme, regexp_extract(u, {_P}, 2) AS host, regexp_extract(u, {_P}, 3) AS path,
        list_filter(string_split(regexp_extract(u, {_P}, 4), '&'), lambda p: regexp_matches(p, '^[^=]*=.+')) AS pairs
      FROM (SELECT page_id, url, rtrim(coalesce(url, ''), '/') AS u FROM pages))))"""


@query(f"SELECT page_id, normal FROM ({_NORMAL_SQL})")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", url.normalize_url(F.col("url")).alias("normal"))


@query(f"SELECT normal, min(page_id) AS page_id, arg_min(url, page_id) AS url FROM ({_NORMAL_SQL}) GROUP BY normal")
def url_dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of every normalised URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", url.normalize_url(F.col("url")).alias("normal"))
    return dedup.first_wins(pages, ["normal"], ["page_id"]).select("normal", "page_id", "url")


_BLOCKED_SQL = " OR ".join(f"h = '{d}' OR ends_with(h, '.{d}')" for d in BLOCKED)


@query(f"SELECT page_id, h AS host FROM (SELECT page_id, lower(regexp_extract(url, {_P}, 2)) AS h FROM pages) WHERE NOT ({_BLOCKED_SQL})")
def blocked_domain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of hosts that aren't blocked, nor below a blocked one."""
    pages = table(spark, sf_dir, "pages").where(~url.host_in(F.col("url"), BLOCKED))
    return pages.select("page_id", url.host(F.col("url")).alias("host"))


_TITLES = """SELECT min(doc_id) AS doc_id, w FROM (
    SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(left(text, 200)), '\\s+'), lambda x: x <> ''))) AS w FROM documents
  ) GROUP BY w"""


@query(f"""
WITH t AS MATERIALIZED ({_TITLES}),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.w, b.w)) AS n, len(a.w) + len(b.w) AS total
  FROM t a JOIN t b ON a.doc_id < b.doc_id AND least(len(a.w), len(b.w)) >= 0.85 * greatest(len(a.w), len(b.w)) - 1e-9)
SELECT a, b, round(n / (total - n), 4) AS similarity FROM p WHERE n / (total - n) >= 0.85 - 1e-9""")
def title_jaccard_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different titles (first 200 characters) with 0.85 of their words in common."""
    words = F.array_sort(text.word_set(F.left("text", F.lit(200)))).alias("words")
    titles = table(spark, sf_dir, "documents").select("doc_id", words).groupBy("words").agg(F.min("doc_id").alias("doc_id"))
    return similarity.similar_sets(titles, "doc_id", "words", 0.85)


@query(f"""
WITH RECURSIVE r AS (SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(left(text, 200)), '\\s+'), lambda x: x <> ''))) AS w FROM documents),
t AS MATERIALIZED (SELECT min(doc_id) AS id, count(*) AS n, w FROM r WHERE len(w) > 0 GROUP BY w),
p AS MATERIALIZED (SELECT a, b FROM (SELECT a.id AS a, b.id AS b, len(list_intersect(a.w, b.w)) AS n, len(a.w) + len(b.w) AS total
    FROM t a JOIN t b ON a.id < b.id AND least(len(a.w), len(b.w)) >= 0.85 * greatest(len(a.w), len(b.w)) - 1e-9) WHERE n / (total - n) >= 0.85 - 1e-9),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
c(id, root) USING KEY (id) AS (SELECT id, id AS root FROM t
  UNION SELECT e.b, min(c.root) FROM c JOIN e ON c.id = e.a JOIN recurring.c AS o ON o.id = e.b WHERE c.root < o.root GROUP BY 1),
l AS (SELECT a AS id, sum(t.n) AS n FROM e JOIN t ON t.id = e.b GROUP BY 1)
SELECT r.doc_id, coalesce(c.root, r.doc_id) AS class_id, coalesce(t.n, 1) AS n_copies, CAST(coalesce(t.n - 1, 0) + coalesce(l.n, 0) AS BIGINT) AS n_links
FROM r LEFT JOIN t ON t.w = r.w LEFT JOIN c ON c.id = t.id LEFT JOIN l ON l.id = t.id""")
def title_similarity_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its title (first 200 characters), the documents that have
    its words, and those with 0.85 of them."""
    titles = table(spark, sf_dir, "documents").select("doc_id", text.word_set(F.left("text", F.lit(200))).alias("words"))
    return similarity.similar_classes(titles, "doc_id", "words", 0.85)


@query(f"""
SELECT doc_id, n_hits, tier, least(CAST(trunc(tier * least(n_hits / 10.0, 1.0) * (CASE WHEN priority THEN 1.5 ELSE 1.0 END) * 100) AS INTEGER), 100) AS score
FROM (SELECT doc_id, len({_hits(KEYWORDS)}) AS n_hits, CASE WHEN source < 'src2' THEN 3 WHEN source < 'src5' THEN 2 ELSE 1 END AS tier,
  len({_hits(PRIORITY, "left(text, 100)")}) > 0 AS priority FROM documents)""")
def keyword_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reliability from the source's tier, keywords, and a boost by the title."""
    tier = F.when(F.col("source") < "src2", 3).when(F.col("source") < "src5", 2).otherwise(1)
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.size(text.hits(F.col("text"), KEYWORDS)).cast("long").alias("n_hits"), tier.alias("tier"),
        text.has_any(F.left("text", F.lit(100)), PRIORITY).alias("priority"),
    )
    return docs.select("doc_id", "n_hits", "tier", reliability_score(F.col("n_hits"), F.col("tier"), F.col("priority")).alias("score"))


@query(
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN len({_hits(words)}) > 0 THEN '{name}'" for name, words in TOPICS)
    + " ELSE 'other' END AS category, CASE "
    + " ".join(f"WHEN len({_hits(words)}) > 0 THEN least(0.25 * len({_hits(words)}), 1.0)" for _, words in TOPICS)
    + " ELSE 0 END::DOUBLE AS confidence FROM documents"
)
def categorize_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first category with a keyword, and a quarter of confidence for each."""
    confidence = F.lit(0.0)
    for _, words in reversed(TOPICS):
        found = text.hits(F.col("text"), words)
        confidence = F.when(F.size(found) > 0, text.category_confidence(found)).otherwise(confidence)
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.first_match(F.col("text"), TOPICS, "other").alias("category"), confidence.alias("confidence")
    )


@query(f"""
SELECT conv_id, turn, CASE WHEN len(found) > 0 THEN array_to_string(found, ',') ELSE 'other' END AS topics FROM (
  SELECT conv_id, turn, list_filter([{', '.join(f"CASE WHEN len({_hits(words)}) > 0 THEN '{name}' END" for name, words in TOPICS)}], lambda x: x IS NOT NULL) AS found
  FROM conversations)""")
def multi_label_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics of every turn."""
    topics = F.array_join(text.all_matches(F.col("text"), TOPICS, "other"), ",")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", topics.alias("topics"))


@query("""
WITH u AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS place FROM conversations WHERE role = 'user')
SELECT c.conv_id, c.first_turn, c.last_turn, c.n_user, c.n_other, coalesce(s.said, '') AS said
FROM (SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn, count(*) FILTER (role = 'user') AS n_user,
        count(*) FILTER (role <> 'user') AS n_other FROM conversations GROUP BY conv_id) c
LEFT JOIN (SELECT conv_id, sha256(string_agg(text, '|' ORDER BY turn, text)) AS said FROM u WHERE place <= 5 GROUP BY conv_id) s USING (conv_id)""")
def conversation_session_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a session, with a digest of the user's first five texts."""
    found = sources.sessions(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    said = F.when(F.size("first_texts") > 0, F.sha2(F.array_join("first_texts", "|"), 256)).otherwise("")
    return found.select("conv_id", "first_turn", "last_turn", "n_user", "n_other", said.alias("said"))


@query("""
SELECT lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC NULLS LAST, doc_id) AS place FROM documents)
WHERE place <= 5""")
def theme_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five longest documents of each language."""
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    return dedup.keep_newest(docs, ["lang"], [F.col("n_chars").desc_nulls_last(), F.col("doc_id")], 5)


@query("SELECT doc_id, length(text) < 50 OR regexp_matches(text, '[0-9]{6,}') OR regexp_matches(text, '(?i)license') AS noise FROM documents")
def noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    noise = text.is_noise(F.col("text"), 50, ("[0-9]{6,}", "(?i)license"))
    return table(spark, sf_dir, "documents").select("doc_id", noise.alias("noise"))


@query(f"""
SELECT doc_id, n AS n_indicators, CASE WHEN (size < 200 AND n >= 1) OR (size < 1500 AND n >= 2) THEN 'paywalled'
  WHEN size < 200 THEN 'insufficient' ELSE 'accessible' END AS status
FROM (SELECT doc_id, len({_hits(INDICATORS)}) AS n, length(text) AS size FROM documents)""")
def paywall_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(text.hits(F.col("text"), INDICATORS)).cast("long").alias("n_indicators"),
        text.paywall_status(F.col("text"), INDICATORS).alias("status"),
    )


@query("""
SELECT 'entity_length' AS rule, count(*) AS total, count(*) FILTER (v) AS violations, round(1 - count(*) FILTER (v) / count(*), 4) AS pass_rate
FROM (SELECT len(list_filter(regexp_split_to_array(left(text, 40), '\\s+'), lambda w: w <> '')) > 5 AS v FROM documents)""")
def entity_length_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "documents").select(F.left("text", F.lit(40)).alias("name"))
    return grouping.rule_result(names, "entity_length", text.too_long_name(F.col("name")))


@query(f"""
SELECT 'subject_reference' AS rule, count(*) AS total, count(*) FILTER (v) AS violations, round(1 - count(*) FILTER (v) / count(*), 4) AS pass_rate
FROM (SELECT lower(regexp_replace(regexp_split_to_array(regexp_replace(text, '^ +| +$', '', 'g'), '\\s+')[1], '[,.;:]+$', '')) IN ({', '.join(f"'{p}'" for p in text.PRONOUNS)}) AS v FROM documents)""")
def subject_reference_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.rule_result(table(spark, sf_dir, "documents"), "subject_reference", text.refers_to_subject(F.col("text")))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
s AS (SELECT *, sum(CASE WHEN length(line) < 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM l)
SELECT doc_id, CAST(section AS BIGINT) AS section, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM s GROUP BY 1, 2""")
def chunk_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of documents that start at a short line, numbered by a running count."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.length(F.get("lines", i)) < 40)
    parts = F.expr("""filter(transform(sequence(0, size(starts)), s -> named_struct('section', s,
        'from', if(s = 0, 0, get(starts, s - 1)), 'to', if(s = size(starts), size(lines), get(starts, s)))), p -> p.to > p.from)""")
    found = lines.withColumn("starts", starts).select("doc_id", "lines", F.explode(parts).alias("p"))
    own = F.slice("lines", F.col("p.from") + 1, F.col("p.to") - F.col("p.from"))
    return found.select(
        "doc_id", F.col("p.section").cast("long").alias("section"), F.size(own).cast("long").alias("n_lines"),
        F.length(F.array_join(own, "")).cast("long").alias("n_chars"),
    )


@query("SELECT page_id, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS heading FROM pages")
def html_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1).alias("heading"))


@query("""
SELECT doc_id, sha256(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''), chr(10))) AS digest FROM documents""")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.clean_lines(F.col("text")), 256).alias("digest"))


@query("SELECT doc_id, left(sha256(text), 32) AS claim_id, left(sha256('fact:' || text), 32) AS fact_id, left(sha256(text), 16) AS content_hash FROM documents")
def id_sha_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", ids.content_id(t).alias("claim_id"), ids.content_id(t, "fact").alias("fact_id"), ids.content_id(t, length=16).alias("content_hash")
    )


@query("""
WITH h AS (SELECT page_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(url)) AS d FROM pages)
SELECT page_id, concat(substr(d, 1, 8), '-', substr(d, 9, 4), '-5', substr(d, 14, 3), '-',
  substr('89ab', (CAST('0x' || substr(d, 17, 1) AS INTEGER) % 4) + 1, 1), substr(d, 18, 3), '-', substr(d, 21, 12)) AS source_id FROM h""")
def id_uuid5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", ids.source_id(F.col("url")).alias("source_id"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_field_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""
SELECT b.bucket, count(e.event_id) AS n FROM (VALUES ('click'), ('view'), ('share'), ('purchase')) b(bucket)
LEFT JOIN events e ON e.event_type = b.bucket GROUP BY 1""")
def fixed_bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of fixed categories, zeros included."""
    return grouping.fixed_buckets(table(spark, sf_dir, "events"), F.col("event_type"), ("click", "view", "share", "purchase"))


@query("""
SELECT conv_id, turn, role, CAST(instr(lower(text), 'the ') AS BIGINT) AS at FROM conversations WHERE contains(lower(text), 'the ')""")
def transcript_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues that contain the query, and where."""
    turns = table(spark, sf_dir, "conversations").where(text.matches_query("the ", F.col("text")))
    return turns.select("conv_id", "turn", "role", F.instr(F.lower("text"), "the ").cast("long").alias("at"))


@query("""
SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before IS NULL OR before <> event_type""")
def consecutive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that differ from the one before of their user."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return dedup.drop_consecutive(events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query()
def html_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article text of pages, by an Arrow function: HTML isn't a regular language."""
    return table(spark, sf_dir, "pages").select("page_id", sources.article_text("html").alias("text"))
