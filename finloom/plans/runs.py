"""Queries of runs, their state and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom import sinks
from finloom.functions import ids, records, text, url
from finloom.operators import dedup, runs, sessions
from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import shared_dir


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("feed_id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("category"), (F.col("c_custkey") % 3 > 0).alias("enabled"))


@query("""
SELECT c_mktsegment AS category, CAST(grouping(c_mktsegment) AS INTEGER) AS is_total, count(*) AS total, count(*) FILTER (c_custkey % 3 > 0) AS enabled, count(*) FILTER (c_custkey % 3 = 0) AS disabled
FROM customer GROUP BY ROLLUP (c_mktsegment)""")
def feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds by category and altogether."""
    found = runs.enabled_counts(_feeds(spark, sf_dir))
    return found.select("category", F.col("is_total").cast("int").alias("is_total"), "total", "enabled", "disabled")


@query("SELECT c_custkey AS feed_id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 3 > 0")
def listed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enabled feeds of a category."""
    return runs.listed(_feeds(spark, sf_dir), "BUILDING", enabled_only=True).select("feed_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def category_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen parts of a registry."""
    return runs.selected(table(spark, sf_dir, "customer"), "c_mktsegment", ("BUILDING", "MACHINERY")).select("c_custkey", "c_name")


@query("""
SELECT c_custkey AS channel_id, count(o_orderkey) AS videos, count(*) FILTER (o_orderstatus = 'O') AS success, count(*) FILTER (o_orderstatus = 'P') AS pending,
  CAST(0 AS BIGINT) AS unavailable, count(*) FILTER (o_orderstatus = 'F') AS failed FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels and their videos by status."""
    status = F.when(F.col("o_orderstatus") == "O", "success").when(F.col("o_orderstatus") == "P", "pending").otherwise("failed")
    videos = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("channel_id"), status.alias("transcript_status"))
    return runs.channel_statistics(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("channel_id")), videos)


@query("""
SELECT count(*) AS judged, round(avg(l_discount), 4) AS factual, round(avg(l_tax), 4) AS source, round(avg(l_quantity / 50), 4) AS temporal,
  round(avg(round(0.4 * l_discount + 0.3 * l_tax + 0.3 * (l_quantity / 50), 3)), 4) AS overall FROM lineitem""")
def mean_judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of judged axes and of their weighted score."""
    return runs.mean_accuracy(table(spark, sf_dir, "lineitem").select(F.col("l_discount").alias("factual"), F.col("l_tax").alias("source"), (F.col("l_quantity") / 50).alias("temporal")))


@query("SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, CAST(0 AS BIGINT) AS skipped FROM orders")
def run_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of results by status."""
    return runs.status_counts(table(spark, sf_dir, "orders"), "o_orderstatus", ("F", "O", "skipped"))


@query("""
WITH p AS (SELECT o_custkey AS page, count(*) FILTER (o_orderkey % 2 = 0) AS hits, count(*) FILTER (o_orderkey % 2 = 0 AND o_orderstatus <> 'P') AS titles, count(*) FILTER (o_orderkey % 2 = 0 AND o_orderkey % 3 > 0) AS dates FROM orders GROUP BY 1),
r AS (SELECT page, CASE WHEN hits = 0 THEN 0.0 ELSE CAST(titles + dates AS DOUBLE) / (2 * hits) END AS rate FROM p)
SELECT page, round(rate, 4) AS hit_rate, CASE WHEN rate >= 0.8 THEN 'healthy' WHEN rate >= 0.5 THEN 'partial_change' WHEN rate > 0 THEN 'major_change' ELSE 'complete_change' END AS status FROM r""")
def page_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of titles and dates that selectors found on a page."""
    hit = F.col("o_orderkey") % 2 == 0
    pages = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("page")).agg(
        F.count_if(hit).alias("hits"), F.count_if(hit & (F.col("o_orderstatus") != "P")).alias("titles"), F.count_if(hit & (F.col("o_orderkey") % 3 > 0)).alias("dates")
    )
    return runs.structure_status(pages).select("page", "hit_rate", "status")


@query("""
SELECT s.status, count(p_partkey) AS n FROM (VALUES ('healthy'), ('partial_change'), ('major_change'), ('complete_change')) s(status)
LEFT JOIN part ON s.status = CASE WHEN p_partkey % 5 > 1 THEN 'healthy' WHEN p_partkey % 5 = 1 THEN 'partial_change' ELSE 'complete_change' END GROUP BY 1""")
def structure_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies by what their validation says, kinds without one included."""
    kind = F.when(F.col("p_partkey") % 5 > 1, "valid").when(F.col("p_partkey") % 5 == 1, "partial")
    return runs.validation_summary(table(spark, sf_dir, "part").select(kind.alias("validation")))


@query("""
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type <> 'error') AS articles, bool_or(event_type = 'error') AS failed FROM events GROUP BY 1, 2)
SELECT day, sum(articles) > 0 OR count(*) FILTER (failed) <> count(*) AS success FROM s GROUP BY 1""")
def collections_succeeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose collection succeeded: articles, or not all sources failed."""
    e = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") != "error").alias("articles"), F.max(F.when(F.col("event_type") == "error", "failed")).alias("error"))
    return runs.collection_succeeded(e.groupBy("day"))


@query("""
SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS deviation, round(min(value), 4) AS least, round(max(value), 4) AS most, round(median(value), 4) AS median FROM events GROUP BY 1""")
def timing_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, deviation, extremes and median of timings."""
    return runs.timing_summary(table(spark, sf_dir, "events"), "event_type", "value")


@query("SELECT max(day) AS day, arg_max(n, day) AS n FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) WHERE day <> DATE '2024-01-30'")
def latest_snapshot_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest snapshot but that of a given day."""
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return runs.latest_snapshot(days, "day", "n", "2024-01-30")


@query("""
SELECT event_id AS item_id, c_name AS feed_title, CAST(ts AS DATE) AS day FROM events JOIN customer ON c_custkey = user_id AND c_custkey % 2 = 0 WHERE ts >= TIMESTAMP '2024-01-30 06:00:00' - INTERVAL 24 HOUR""")
def recent_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of known feeds from the last day, by when they were published or else fetched."""
    e = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    items = e.select(F.col("user_id").alias("feed_id"), F.col("event_id").alias("item_id"), F.when(F.col("event_id") % 2 == 0, at).alias("published"), at.alias("fetched_at"))
    found = runs.recent_items(items, _feeds(spark, sf_dir).where("feed_id % 2 = 0"), F.lit("2024-01-30 06:00:00").cast("timestamp"), 24)
    return found.select("item_id", "feed_title", F.to_date("at").alias("day"))


@query("""
SELECT l_orderkey AS document, l_linenumber AS table_id, CAST(least((l_partkey % 40) // greatest(1, CAST(ceil(40 / (o_custkey % 9)) AS BIGINT)), o_custkey % 9 - 1) AS BIGINT) AS chunk
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 9 > 0""")
def tables_of_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk that every table's page belongs to."""
    tables = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("table_id"), (F.col("l_partkey") % 40 + 1).alias("page"))
    documents = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document"), (F.col("o_custkey") % 9).alias("n_chunks"), F.lit(40).alias("n_pages"))
    return runs.associated(tables, documents)


@query("""
WITH t AS (SELECT conv_id, string_agg(role || turn, ' ' ORDER BY turn) AS text FROM conversations GROUP BY 1)
SELECT o_orderkey AS video_id, 'https://www.youtube.com/watch?v=' || o_orderkey AS url, o_orderpriority AS title, 'YouTube/' || o_custkey AS feed_source, text
FROM orders JOIN t ON conv_id = o_orderkey WHERE o_orderstatus = 'O'""")
def exported_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos with a transcript as queue documents."""
    o = table(spark, sf_dir, "orders")
    videos = o.select(F.col("o_orderkey").alias("video_id"), F.col("o_custkey").alias("channel_id"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderstatus") == "O", "success").otherwise("failed").alias("status"))
    said = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("video_id")).agg(F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.col("turn").cast("string")).alias("t")))).alias("x"))
    address = _text("https://www.youtube.com/watch?v=", F.col("video_id"))
    out = runs.exported_transcripts(videos, said.select("video_id", F.transform("x", lambda x: x["t"]).alias("lines")), ids.source_id(address), address)
    return out.select("video_id", "url", "title", "feed_source", "text")


@query("""
WITH s AS (SELECT user_id AS run_id, max(ts) AS at_ FROM events WHERE event_type = 'signup' GROUP BY 1), e AS (SELECT user_id AS run_id, arg_max(event_type, ts) AS status, max(ts) AS end_at FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 1)
SELECT coalesce(s.run_id, c_custkey) AS run_id, CASE WHEN e.run_id IS NOT NULL THEN e.status WHEN s.run_id IS NOT NULL THEN 'running' ELSE 'old' END AS status,
  CASE WHEN e.run_id IS NOT NULL THEN CAST(e.end_at AS DATE) END AS end_day FROM s FULL JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) c ON c_custkey = s.run_id LEFT JOIN e ON e.run_id = coalesce(s.run_id, c_custkey)""")
def skill_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs after starts, which make or renew them, and ends, which only change known ones."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    none = F.lit(None).cast("string")
    old = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("run_id"), F.lit("skill").alias("name"), F.lit("s").alias("session_id"), F.lit("old").alias("status"),
        F.lit(None).cast("timestamp").alias("start_at"), F.lit(None).cast("timestamp").alias("end_at"), none.alias("summary"),
    )
    starts = e.where("event_type = 'signup'").select(F.col("user_id").alias("run_id"), F.lit("skill").alias("name"), F.lit("s").alias("session_id"), F.col("ts").alias("start_at"), F.repeat(F.lit("long "), F.lit(100)).alias("summary"))
    ends = e.where("event_type IN ('error', 'purchase')").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("status"), F.col("ts").alias("end_at"))
    return runs.completed(runs.started(old, starts), ends).select("run_id", "status", F.to_date("end_at").alias("end_day"))


@query("SELECT DISTINCT o_custkey AS src, o_orderkey % 1000 AS dst FROM orders WHERE o_custkey % 2 = 0 AND o_orderkey % 1000 % 2 = 0 AND o_orderkey % 1000 IN (SELECT c_custkey FROM customer)")
def invoked_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls between known runs, each once."""
    known = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("run_id"))
    calls = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("parent_id"), (F.col("o_orderkey") % 1000).alias("child_id"))
    return runs.invoked(known, calls)


@query("""
WITH c AS (SELECT conv_id, role, text FROM conversations), t AS (SELECT DISTINCT conv_id, 'topic:' || role AS topic FROM c)
SELECT 'Session' AS kind, count(DISTINCT conv_id) AS n FROM c UNION ALL SELECT 'Topic', count(DISTINCT topic) FROM t UNION ALL SELECT 'Project', 1
UNION ALL SELECT 'HAS_SESSION', count(DISTINCT conv_id) FROM c UNION ALL SELECT 'DISCUSSED', count(*) FROM t""")
def conversation_graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions, topics and a project as a graph."""
    found = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("session_id")).agg(F.collect_set(F.concat(F.lit(" "), F.upper("role"))).alias("topics"))
    nodes, edges = runs.conversation_graph(found, "finance")
    return nodes.groupBy(F.col("label").alias("kind")).agg(F.count("*").alias("n")).unionByName(edges.groupBy(F.col("type").alias("kind")).agg(F.count("*").alias("n")))


@query("""
WITH n AS (SELECT user_id AS video_id, arg_max(event_type, (ts, event_id)) AS status FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT c_custkey AS video_id, 'pending' AS status FROM customer WHERE c_custkey NOT IN (SELECT video_id FROM n) UNION ALL SELECT * FROM n""")
def transcript_state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos after a collection of transcripts."""
    existing = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("video_id"), F.lit("pending").alias("status"), F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("long").alias("n"))
    new = table(spark, sf_dir, "events").where("event_type <> 'view'").select(F.col("user_id").alias("video_id"), F.col("event_type").alias("status"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("n"))
    return runs.transcript_states(existing, new, ["at", "n"]).select("video_id", "status")


@query("""
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'time_series' WHEN 1 THEN 'estimate_change' WHEN 2 THEN 'key_value' ELSE 'raw' END AS table_type, CASE WHEN p_partkey % 5 < 3 THEN p_name END AS title FROM part""")
def typed_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables by the kind that their JSON states."""
    kind = F.get(F.array(*map(F.lit, ("Time_Series", "estimate_change ", "key_value", "unknown"))), (F.col("p_partkey") % 5).cast("int"))
    raw = F.when(F.col("p_partkey") % 5 < 4, F.to_json(F.struct(kind.alias("table_type"), F.col("p_name").alias("title")))).otherwise("no json")
    return runs.typed_tables(table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")), "raw")


@query("""
SELECT page_id, CASE WHEN page_id % 3 < 2 THEN url END AS overview, CASE WHEN page_id % 3 < 2 THEN 2 END AS n_points FROM pages""")
def parsed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with a fenced or a bare JSON object; others give nulls."""
    body = F.to_json(F.struct(F.col("url").alias("overview"), F.array(F.lit("a"), F.lit("b")).alias("key_points")))
    answer = F.when(F.col("page_id") % 3 == 0, _text("Here:\n```json\n", body, "\n```\nDone {")).when(F.col("page_id") % 3 == 1, _text("  ", body, "\n")).otherwise("no answer")
    found = table(spark, sf_dir, "pages").select("page_id", F.from_json(text.fenced_json(answer), "overview string, key_points array<string>").alias("s"))
    return found.select("page_id", "s.overview", F.when(F.col("s.key_points").isNotNull(), F.size("s.key_points")).alias("n_points"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'topic ' || o_orderkey ELSE 'title' END AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'published' ELSE 'research' END AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN 'done' WHEN o_orderkey % 5 = 1 THEN 'in_progress' ELSE 'pending' END AS draft, CASE WHEN o_orderkey % 5 < 3 THEN 'done' ELSE 'pending' END AS research, 'pending' AS publish,
  'a/' || o_orderkey AS old_path, CASE WHEN o_orderkey % 4 = 0 THEN 'p' || o_custkey END AS old_id FROM orders""")
def migrated_article_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of articles in its new form."""
    key = F.col("o_orderkey")
    flow = F.map_filter(
        F.create_map(F.lit("writing"), F.when(key % 5 < 2, "done"), F.lit("draft"), F.when(key % 5 == 0, "done").when(key % 5 == 1, "pending"), F.lit("research"), F.when(key % 5 < 3, "done")), lambda _, v: v.isNotNull()
    )
    old = F.to_json(F.struct(F.when(key % 2 == 0, _text("topic ", key)).otherwise("").alias("topic"), F.lit("title").alias("title"), F.when(key % 3 == 0, "published").alias("status"), F.when(key % 4 == 0, _text("p", F.col("o_custkey"))).alias("pattern_id"), flow.alias("workflow")))
    raw = table(spark, sf_dir, "orders").select("o_orderkey", old.alias("raw"), F.lit("c").alias("category"), _text("a/", key).alias("path"))
    found = records.article_meta(raw, "raw", "category", "path", F.lit("now"))
    w = lambda p: F.col("workflow")[p].alias(p)
    return found.select(F.substring("legacy.old_path", 3, 20).cast("long").alias("o_orderkey"), "title", "status", w("draft"), w("research"), w("publish"), "legacy.old_path", F.col("legacy.old_article_id").alias("old_id"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'in_progress' ELSE 'pending' END AS status FROM orders""")
def phase_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of phases by their parts."""
    k = F.col("o_orderkey") % 4
    second = F.when(k == 0, "done").when(k == 1, "open").when(k == 2, "open")
    parts = F.when(k == 3, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("a"), F.when(k < 2, "done"), F.lit("b"), second, F.lit("c"), F.lit(None).cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", records.phase_status(parts).alias("status"))


@query("""
SELECT s_nationkey, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS at_, '1.' || s_suppkey AS task, s_name AS title, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS INTEGER) END AS issue,
  CASE WHEN s_suppkey % 3 = 0 THEN 'high' ELSE 'medium' END AS priority, CASE WHEN s_suppkey % 4 = 0 THEN 'done' ELSE 'todo' END AS status, CAST(s_suppkey % 2 AS INTEGER) * 2 AS n_needed FROM supplier""")
def project_task_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of project files, section by section."""
    key = F.col("s_suppkey")
    section = _text(
        "#### Part 1.", key, ": ", F.col("s_name"), "\n", F.when(key % 2 == 0, _text("Issue: [#", key, "]\n")).otherwise("depends_on: [#7]\ndepends_on: [#8]\n"),
        F.when(key % 3 == 0, "Priority: HIGH\n").otherwise(""), F.when(key % 4 == 0, "status: done\n").otherwise(""),
    )
    files = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", section.alias("t")))).alias("x"))
    body = _text("# Project\n", F.array_join(F.transform("x", lambda x: x["t"]), ""))
    found = records.project_tasks(files.select("s_nationkey", body.alias("body")), "s_nationkey", "body")
    return found.select("s_nationkey", F.col("at").cast("int").alias("at_"), "task", "title", "issue", "priority", "status", F.size("depends_on").alias("n_needed"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '**' || p_name END AS text, p_partkey % 2 = 0 AS bold, 'body ' || p_partkey || chr(10) AS body,
  left(sha256('topic:' || replace(p_name, ' ', '-') || ':g1'), 8) AS topic, p_partkey % 3 = 0 OR p_partkey % 3 = 1 AND p_size < 20 AS retry FROM part""")
def cell_and_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bold cells, texts without their history, topic ids, extractions to try again."""
    key = F.col("p_partkey")
    cell = records.bold_cell(F.when(key % 2 == 0, F.concat(F.lit(" **"), "p_name", F.lit("** "))).otherwise(F.concat(F.lit("**"), "p_name")))
    history = text.before_marker(F.concat(F.lit("body "), key.cast("string"), F.lit("\n"), F.lit("## History\nold\n## History\n")), "## History")
    status = F.when(key % 3 == 0, "failed").when(key % 3 == 1, "success").otherwise("skipped")
    return table(spark, sf_dir, "part").select(
        "p_partkey", cell["text"].alias("text"), cell["bold"].alias("bold"), history.alias("body"), ids.creator_topic_id(text.slug(F.col("p_name")), F.lit("g1")).alias("topic"),
        text.should_fall_back(status, F.repeat(F.lit("x"), F.col("p_size") * 10)).alias("retry"),
    )


_BROWSED = ("example.org", "thth.example.com", "EXAMPLE.net")
_HOST = "lower(regexp_extract(url, '^https?://([^/?#]*)', 1))"


@query(f"""
SELECT page_id, {" OR ".join(f"({_HOST} = '{d.lower()}' OR {_HOST} LIKE '%.{d.lower()}')" for d in _BROWSED)} AS plain, plain AS served,
  CASE WHEN page_id % 2 = 0 THEN false ELSE plain END AS blocked FROM pages""")
def browser_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose host, or a domain above it, needs a browser: as they are and with user
    and port, which the host that serves a page is found without."""
    parts = F.regexp_extract("url", r"^(https?)://([^/?#]*)(.*)$", 2)
    server = F.concat(F.lit("://Me:pw@"), F.upper(parts), F.lit(":8443"))
    address = F.concat(F.regexp_extract("url", "^https?", 0), server, F.regexp_extract("url", r"^https?://[^/?#]*(.*)$", 1))
    # With a port, what is to be skipped has to name it.
    ported = F.when(F.col("page_id") % 2 == 0, address).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", url.host_in(F.col("url"), _BROWSED, url.hostname).alias("plain"), url.host_in(address, _BROWSED, url.hostname).alias("served"), url.host_in(ported, _BROWSED).alias("blocked")
    )


@query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'title is missing' WHEN 2 THEN 'scheme is not http or https' WHEN 3 THEN 'enabled is not a boolean' WHEN 4 THEN 'url is missing,url is empty'
  ELSE 'not an object,url is missing,title is missing,category is missing,url is empty' END AS errors, CASE WHEN p_partkey % 6 = 3 THEN 'unknown interval,tier is not an integer' ELSE '' END AS warnings FROM part""")
def preset_entry_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presets with their errors and warnings."""
    k = F.col("p_partkey") % 6
    entry = (
        F.when(k == 0, '{"url": "https://a.com/f", "title": "t", "category": "c", "enabled": true, "tier": 2, "fetch_interval": "daily"}')
        .when(k == 1, '{"url": "https://a.com/f", "category": "c"}')
        .when(k == 2, '{"url": "ftp://a.com/f", "title": "t", "category": "c"}')
        .when(k == 3, '{"url": "https://a.com/f", "title": "t", "category": "c", "enabled": "yes", "tier": "one", "fetch_interval": "hourly"}')
        .when(k == 4, '{"title": "t", "category": "c"}')
        .otherwise("[1]")
    )
    found = sessions.preset_problems(table(spark, sf_dir, "part").select("p_partkey", entry.alias("raw")), "raw", ("daily", "weekly"))
    return found.select("p_partkey", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


@query("SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AS done FROM part")
def already_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs and whether a run has completed them."""
    state = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.when(F.col("l_returnflag") == "R", "completed").otherwise("failed").alias("status"))
    return dedup.processed(table(spark, sf_dir, "part").select("p_partkey"), state, "p_partkey")


@query("""
SELECT o_orderpriority AS priority, count(*) FILTER (o_orderpriority > '3' OR o_totalprice > 100000) AS n, count(*) FILTER (o_orderpriority < '3' AND o_totalprice > 100000) AS changed
FROM orders GROUP BY 1""")
def replaced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose folders of two priorities are written anew, with fewer rows; others stay."""
    path = shared_dir(spark, "partitions")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("priority"))
    sinks.replace_partition(o.withColumn("v", F.lit("old")), path, "priority")
    sinks.replace_partition(o.where("priority < '3' AND o_totalprice > 100000").withColumn("v", F.lit("new")), path, "priority")
    return spark.read.parquet(path).groupBy("priority").agg(F.count("*").alias("n"), F.count_if(F.col("v") == "new").alias("changed"))


@query("""
SELECT '2024-01-01' AS dt, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT '2024-01-02', o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000
UNION ALL SELECT '2024-01-02', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'""")
def appended_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs under their days, two of them of one day."""
    path = shared_dir(spark, "run-log")
    o = table(spark, sf_dir, "orders")
    for day, part in (("2024-01-01", "o_orderstatus <> 'F'"), ("2024-01-02", "o_totalprice > 100000"), ("2024-01-02", "o_orderstatus = 'P'")):
        sinks.append_run(o.where(part).select("o_orderkey", "o_totalprice"), path, day)
    return spark.read.parquet(path).select(F.col("dt").cast("string").alias("dt"), "o_orderkey", "o_totalprice")


@query("SELECT s_suppkey, s_name, s_suppkey % 2 = 0 AS has_even FROM supplier")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON documents in lines, appended in two runs, and read again."""
    path = shared_dir(spark, "lines")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, 1).alias("even"))
    documents = sinks.json_documents(s, "s_suppkey")
    for part in (0, 1):
        sinks.append_lines(documents.where(F.col("s_suppkey") % 2 == part), path)
    read = spark.read.schema("s_suppkey long, document string").json(path)
    parsed = F.from_json("document", "s_suppkey long, s_name string, even int")
    return read.select(parsed["s_suppkey"].alias("s_suppkey"), parsed["s_name"].alias("s_name"), parsed["even"].isNotNull().alias("has_even"))


@query("""
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS number, count(*) OVER (PARTITION BY event_type) AS n_of_category FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'""")
def converted_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of a period, numbered, and the size of their category."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("category"), F.to_date("ts").alias("published"))
    kept, counts = sinks.converted_news(e, "2024-01-10", "2024-01-19", ["ts", "event_id"])
    return kept.join(counts, "category").select("event_id", "number", F.col("n").alias("n_of_category"))


@query("""
SELECT rtrim(rpad(CAST(c_custkey AS VARCHAR), 8, ' ') || '  ' || rpad(coalesce(c_name, ''), 15, ' ') || '  ' || rpad(coalesce(CAST(round(c_acctbal) AS BIGINT)::VARCHAR, ''), 4, ' ') || '  ' || rpad(coalesce(c_mktsegment, ''), 12, ' ')) AS line FROM customer""")
def padded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as a table of text, values that are too long cut."""
    rounded = table(spark, sf_dir, "customer").withColumn("balance", F.round("c_acctbal").cast("long"))
    return records.padded_table(rounded, {"c_custkey": 8, "c_name": 15, "balance": 4, "c_mktsegment": 12})


@query("SELECT doc_id, CAST(strlen(text) AS INTEGER) AS size FROM documents WHERE lang = 'en'")
def processed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A processor applied to a table."""
    return table(spark, sf_dir, "documents").transform(lambda df: df.where("lang = 'en'").select("doc_id", F.octet_length("text").alias("size")))
