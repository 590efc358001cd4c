"""Session preparation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions import dates, ids, url
from finloom.operators import sessions
from finloom.plans.catalog import query
from finloom.plans.news import _NORMAL_SQL, _P
from finloom.session import table

_THEMES = (("english", "src0", ["the "]), ("license", "src1", ["license"]), ("mixed", "src0", ["que ", "der "]))


@query("""
WITH t AS (SELECT * FROM (VALUES ('english', 'src0', ['the ']), ('license', 'src1', ['license']), ('mixed', 'src0', ['que ', 'der '])) t(theme, source, keywords)),
m AS (SELECT theme, doc_id, n_chars FROM documents JOIN t USING (source) WHERE len(list_filter(keywords, lambda k: contains(lower(text), k))) > 0)
SELECT theme, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY n_chars DESC NULLS LAST, doc_id) AS place FROM m) WHERE place <= 10""")
def theme_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per theme: its sources' items, those with a keyword, the ten foremost."""
    items = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "source", "text", F.col("n_chars").alias("at"))
    themes = spark.createDataFrame(_THEMES, "theme string, source string, keywords array<string>")
    return sessions.theme_items(items, themes, 10).select("theme", F.col("item_id").alias("doc_id"))


@query(f"""
WITH p AS (SELECT page_id, url, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS title FROM pages),
n AS (SELECT page_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(title), '\\s+'), lambda x: x <> ''))) AS w,
  concat(lower(regexp_extract(rtrim(url, '/'), {_P}, 2)), regexp_extract(rtrim(url, '/'), {_P}, 3)) AS u FROM p),
c AS (SELECT a.page_id AS new_id, b.page_id AS known_id FROM n a JOIN n b ON a.page_id % 2 = 1 AND b.page_id % 2 = 0 AND len(a.w) > 0 AND len(b.w) > 0
  AND len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) >= 0.85 - 1e-9)
SELECT new_id, min(known_id) AS known_id FROM c GROUP BY 1""")
def duplicates_of_known_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first known page (even ids) whose heading a new one (odd ids) repeats."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1).alias("title"))
    new = pages.where("page_id % 2 = 1").select(F.col("page_id").alias("id"), F.lit(None).cast("string").alias("url"), "title")
    known = pages.where("page_id % 2 = 0").select(F.col("page_id").alias("pos"), F.col("page_id").alias("id"), F.lit(None).cast("string").alias("url"), "title")
    return sessions.known_duplicates(new, known).select("new_id", "known_id")


@query(f"""
SELECT lower(regexp_extract(u, {_P}, 2)) AS host, count(*) AS n FROM (SELECT unnest(list_distinct(regexp_extract_all(coalesce(html, '') || ' see ' || url || ' and (' || url || ')', '(https?://[^\\s)\\]>"'']+)', 1))) AS u FROM pages) GROUP BY 1""")
def linked_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of the URLs in pages, which name their own address twice."""
    body = F.concat(F.coalesce("html", F.lit("")), F.lit(" see "), "url", F.lit(" and ("), "url", F.lit(")"))
    found = F.array_distinct(F.regexp_extract_all(body, F.lit(r"""(https?://[^\s)\]>"']+)"""), F.lit(1)))
    flat = table(spark, sf_dir, "pages").select(F.explode(found).alias("u"))
    return flat.groupBy(url.host(F.col("u")).alias("host")).agg(F.count("*").alias("n"))


@query("""
SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS local FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""")
def recent_local_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last week before a day, with their time in Tokyo."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"))
    now = F.to_timestamp(F.lit("2024-01-31"))
    text = F.date_format("at", "yyyy-MM-dd HH:mm:ss")
    return events.where(dates.recent(F.col("at"), now, 7, keep_null=False)).select("event_id", dates.in_zone(text).alias("local"))


@query("""
SELECT o_orderkey, left(sha256(concat(o_custkey, ':', o_orderpriority, ':', year(o_orderdate))), 32) AS datapoint_id, concat(o_custkey, '_chunk_', o_orderkey) AS chunk_id FROM orders""")
def derived_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of data points and chunks from their fields."""
    text = lambda c: F.col(c).cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        ids.datapoint_id(text("o_custkey"), F.col("o_orderpriority"), F.year("o_orderdate").cast("string")).alias("datapoint_id"),
        F.concat_ws("_chunk_", text("o_custkey"), text("o_orderkey")).alias("chunk_id"),
    )


@query("""
WITH d AS (SELECT user_id, count(*) FILTER (event_type <> 'error') AS s, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY 1)
SELECT user_id, s AS success_count, e AS error_count, s + e AS article_count FROM d""")
def source_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of sources over the runs (days) of a log."""
    events = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "user_id")
    counts = events.agg(F.count_if(F.col("event_type") != "error").alias("success_count"), F.count_if(F.col("event_type") == "error").alias("error_count"), F.count("*").alias("article_count"))
    runs = counts.select(F.create_map(F.col("user_id").cast("string"), F.struct("success_count", "error_count", "article_count")).alias("sources"))
    return sessions.source_statistics(runs).select(F.col("source").cast("long").alias("user_id"), "success_count", "error_count", "article_count")


@query("""
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events WHERE event_type = 'error')
WHERE place <= greatest(1, 300 // greatest(1, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'error')))""")
def backfill_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run over failed rows takes: an equal share of 300 for every user."""
    failed = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("user_id").alias("domain"), F.col("event_id").alias("url"), F.col("ts").alias("at"))
    return sessions.quota_by_domain(failed, 300).select(F.col("domain").alias("user_id"), F.col("url").alias("event_id"))


@query(f"""
SELECT page_id, normal || CASE WHEN page_id % 2 = 0 THEN '' ELSE ' https://other.example/x/' END AS urls FROM ({_NORMAL_SQL})""")
def issue_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal URLs that issues about pages name, each once, without those of the tracker itself."""
    address = F.col("url")
    more = F.when(F.col("page_id") % 2 == 0, "").otherwise('<a href="https://www.other.example/x/?utm_source=i">')
    body = F.concat(F.lit("- [page]("), address, F.lit(") of https://github.com/o/r/issues/"), F.col("page_id").cast("string"), F.lit("\n> "), address, F.lit("\n"), more)
    found = table(spark, sf_dir, "pages").select("page_id", sessions.urls_in(body).alias("urls"))
    return found.select("page_id", F.array_join("urls", " ").alias("urls"))
