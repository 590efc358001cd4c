"""Queries of rules on single values, checks of plans, and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom import sinks
from finloom.functions import dates, finance, records, url
from finloom.operators import reports, sessions
from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import shared_dir

SITE = "https://news.example.com"


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query(f"""
WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '{SITE}/blog/a' WHEN 1 THEN '{SITE}/tag/x.PDF?a=b' WHEN 2 THEN 'https://other.example.org/blog/' WHEN 3 THEN 'ftp://news.example.com/blog/a.pdf' ELSE '/blog/b' END AS u FROM pages)
SELECT page_id, contains(u, '/blog/') AS is_post, u LIKE '{SITE}%' AS same, u LIKE '%.PDF?%' OR u LIKE '%.pdf' AS is_pdf, u LIKE 'https://%' AS is_web FROM p""")
def url_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts by their path, addresses of one site, PDF files, web addresses."""
    k = F.col("page_id") % 5
    u = F.when(k == 0, f"{SITE}/blog/a").when(k == 1, f"{SITE}/tag/x.PDF?a=b").when(k == 2, "https://other.example.org/blog/").when(k == 3, "ftp://news.example.com/blog/a.pdf").otherwise("/blog/b")
    p = table(spark, sf_dir, "pages").select("page_id", u.alias("u"))
    return p.select(
        "page_id", url.has_segment(F.col("u"), ["/blog/"]).alias("is_post"), url.same_site(F.col("u"), F.lit(SITE + "/sitemap.xml")).alias("same"), url.is_pdf(F.col("u")).alias("is_pdf"), url.is_web_url(F.col("u")).alias("is_web")
    )


@query("""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'no issue' WHEN o_orderkey % 5 = 1 THEN 'unknown issue' WHEN o_orderstatus = 'F' THEN 'done but open' ELSE 'closed but not done' END AS problem
FROM orders WHERE o_orderkey % 5 < 2 OR (o_orderstatus = 'F' AND o_custkey % 2 = 0) OR (o_orderstatus <> 'F' AND o_custkey % 2 = 1)""")
def task_status_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks that disagree with their issue, or have none."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 5
    tasks = o.select(F.col("o_orderkey").alias("id"), F.when(k == 1, -1).when(k > 1, F.col("o_custkey")).cast("long").alias("issue"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("todo").alias("status"))
    issues = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("number"), F.when(F.col("c_custkey") % 2 == 0, "open").otherwise("closed").alias("state"))
    return reports.status_mismatches(tasks, issues)


@query("SELECT DISTINCT event_type AS label, 'not in capitals' AS problem FROM events UNION ALL SELECT DISTINCT c_mktsegment, 'unknown' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def label_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that aren't in capitals, or unknown."""
    labels = table(spark, sf_dir, "events").select(F.col("event_type").alias("label")).unionByName(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("label")))
    return reports.label_violations(labels, ("BUILDING", "MACHINERY"))


@query("""
SELECT p_partkey, CASE WHEN p_name LIKE 'small%' THEN 'Small' WHEN p_name LIKE 's%' THEN 'S' ELSE 'General' END AS category FROM part""")
def prefix_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories by the first prefix that fits."""
    return table(spark, sf_dir, "part").select("p_partkey", records.prefix_category(F.col("p_name"), (("small", "Small"), ("s", "S"))).alias("category"))


@query("""
WITH c AS (SELECT o_custkey AS source, min('ch' || o_orderkey) AS chunk FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT o_orderkey AS src, coalesce(chunk, 'S' || o_custkey || '_chunk_0') AS dst, chunk IS NULL AS made FROM orders LEFT JOIN c ON source = o_custkey WHERE o_orderstatus = 'O'""")
def fact_chunk_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and their source's first chunk, made where there is none."""
    o = table(spark, sf_dir, "orders")
    source = _text("S", F.col("o_custkey")).alias("source")
    facts = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"), source)
    chunks = o.where("o_orderstatus = 'F'").select(_text("ch", F.col("o_orderkey")).alias("id"), source)
    links, made = reports.chunk_links(facts, chunks)
    return links.join(made.select(F.col("id").alias("dst"), F.lit(True).alias("m")), "dst", "left").select("src", "dst", F.coalesce("m", F.lit(False)).alias("made"))


@query("SELECT a.s_suppkey AS id, a.s_suppkey // 2 AS dep FROM supplier a WHERE a.s_suppkey % 3 > (a.s_suppkey // 2) % 3")
def priority_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of a higher priority than one they need."""
    k = F.col("s_suppkey")
    level = F.when(k % 3 == 0, "low").when(k % 3 == 1, "unheard of").otherwise("high")
    tasks = table(spark, sf_dir, "supplier").select(k.alias("id"), level.alias("priority"), F.array(F.floor(k / 2).cast("long")).alias("depends_on"))
    return sessions.priority_violations(tasks)


@query("""
SELECT event_type AS stage, count(*) AS total, count(*) FILTER (value >= 5) AS success, count(*) FILTER (value < 5) AS failed FROM events GROUP BY 1""")
def workflow_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of every stage of a run."""
    return reports.stage_counts(table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), F.when(F.col("value") >= 5, "success").otherwise("failed").alias("status")))


@query("""
SELECT count(*) AS total, count(*) FILTER (p_partkey % 3 > 0) AS resolved, count(*) FILTER (p_partkey % 3 = 0) AS new, count(*) FILTER (p_partkey % 3 = 1) AS fuzzy FROM part""")
def resolution_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a resolution by layer."""
    k = F.col("p_partkey") % 3
    layers = table(spark, sf_dir, "part").select(F.when(k == 0, "new").when(k == 1, "fuzzy").otherwise("exact").alias("layer"))
    return reports.layered_counts(layers).select("total", "resolved", "new", F.col("by_layer")["fuzzy"].alias("fuzzy"))


@query("""
SELECT user_id AS source, count(*) FILTER (event_type <> 'error') AS reports, count(*) FILTER (event_type = 'error') AS errors, round(sum(value), 2) AS seconds FROM events GROUP BY 1""")
def report_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports, errors and time of every source of a run."""
    return reports.source_table(table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("seconds")))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS number FROM orders")
def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from 1 in order of date."""
    return reports.numbered(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "number")


@query("SELECT 50 AS n, 100 AS ends, true AS distinct_ends")
def sampled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty pairs of different nodes, a sample that is the same every time."""
    nodes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    pairs = reports.sample_pairs(nodes, 50)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    return pairs.agg(F.count("*").cast("int").alias("n")).crossJoin(ends.agg(F.countDistinct("id").cast("int").alias("ends"), (F.countDistinct("id") == F.count("*")).alias("distinct_ends")))  # one row each


@query("""
WITH s AS (SELECT p_partkey AS id, 0.7 * CASE WHEN contains(p_name, 'rin') THEN 1.0 ELSE greatest(1 - levenshtein(split_part(p_name, ' ', 1), 'rin') / greatest(length(split_part(p_name, ' ', 1)), 3), 1 - levenshtein(split_part(p_name, ' ', 2), 'rin') / greatest(length(split_part(p_name, ' ', 2)), 3)) END
  + 0.3 * (CASE WHEN contains(lower(p_type), 'rin') THEN 1.0 ELSE 1 - levenshtein(lower(p_type), 'rin') / greatest(length(p_type), 3) END) AS score, p_name, p_type FROM part)
SELECT id, round(score, 4) AS score FROM s WHERE round(score, 4) >= 0.4 ORDER BY round(score, 4) DESC, p_name, p_type, id LIMIT 20""")
def component_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty parts that are most like a word."""
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_type")
    return sessions.fuzzy_search(items, "rin", {"p_name": 0.7, "p_type": 0.3}, tie="id").select("id", "score")


@query("""
SELECT p_partkey, unnest(['heading', 'paragraph', 'list', 'quote', 'image', 'table', 'separator']) AS kind, unnest(['Title ' || p_partkey, 'plain ' || p_name, 'item', 'said', '![a](b)', '| a |', '---']) AS content FROM part""")
def markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text as typed blocks."""
    body = _text("## Title ", F.col("p_partkey"), "\n\nplain ", F.col("p_name"), "  \n- item\n> said\n![a](b)\n| a |\n---\n")
    return table(spark, sf_dir, "part").select("p_partkey", F.inline(records.blocks(body)).alias("kind", "content"))


@query("""
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS first_dep, 2 AS n_deps, 'k-' || o_orderkey AS sheet, CASE WHEN o_orderkey % 3 = 0 THEN 'AB' || o_custkey % 10 WHEN o_orderkey % 3 = 1 THEN '^GSPC' END AS ticker, o_orderkey % 2 = 0 AS numeric_right,
  CASE WHEN o_orderkey % 4 = 0 THEN 'done' WHEN o_orderkey % 4 = 1 THEN 'in_progress' ELSE 'pending' END AS status, least(60.0, pow(2.0, o_orderkey % 9)) AS wait_s FROM orders""")
def value_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dependencies, keys of sheets, tickers, alignment, best status, waits."""
    key = F.col("o_orderkey")
    body = _text("Depends on #1\nblocked by: #", F.col("o_custkey"), " and Blocked by #7; unblocked by #9")
    ticker = F.when(key % 3 == 0, _text(" ab", F.col("o_custkey") % 10, " ")).when(key % 3 == 1, "^gspc").otherwise("not a ticker")
    cells = F.when(key % 2 == 0, F.array(F.lit("1,000"), F.lit("x"), F.lit(""))).otherwise(F.array(F.lit("1"), F.lit("x"), F.lit("y")))
    statuses = F.when(key % 4 == 0, F.array(F.lit("done"))).when(key % 4 == 1, F.array(F.lit("done"), F.lit("pending"))).when(key % 4 == 2, F.array(F.lit("pending"))).otherwise(F.array().cast("array<string>"))
    deps = records.dependencies(body, "blocked by")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.element_at(deps, 1).alias("first_dep"), F.size(deps).alias("n_deps"),
        records.spreadsheet_key(F.when(key % 2 == 0, _text("https://docs.google.com/spreadsheets/d/k-", key, "/edit#gid=0")).otherwise(_text("k-", key))).alias("sheet"),
        records.valid_ticker(ticker).alias("ticker"), records.right_aligned(cells).alias("numeric_right"), records.best_status(statuses).alias("status"),
        finance.backoff_seconds(key % 9 + 1).alias("wait_s"),
    )


@query("""
SELECT event_id, CAST(1500 + event_id % 7 * 1000 AS BIGINT) AS ms, event_id % 2 = 0 AS has_range FROM events""")
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Milliseconds between times, and periods in their new form."""
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.date_format(F.col("ts").cast("timestamp") + F.make_interval(secs=F.lit(1) + F.col("event_id") % 7), "yyyy-MM-dd'T'HH:mm:ss'.5Z'")
    span = dates.date_range(F.when(F.col("event_id") % 2 == 0, start), F.when(F.col("event_id") % 2 == 0, end))
    return table(spark, sf_dir, "events").select("event_id", dates.duration_ms(start, end).alias("ms"), (span["start"] != "").alias("has_range"))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def appended_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of every key, appended in two runs."""
    path = shared_dir(spark, "append")
    e = table(spark, sf_dir, "events").select("user_id", "event_id")
    half = table(spark, sf_dir, "events").count() // 2
    sinks.append_new(e.where(F.col("event_id") < half), path, "user_id", ["event_id"])
    return sinks.append_new(e, path, "user_id", ["event_id"])


@query("""
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS sources FROM orders GROUP BY 1""")
def article_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of every day's file of articles."""
    articles = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("published"), F.col("o_orderpriority").alias("source"))
    found = sinks.article_file(articles).select("day", F.from_json("meta", "n long, sources array<string>").alias("m"))
    return found.select("day", "m.n", F.array_join("m.sources", ",").alias("sources"))


@query("""
SELECT 'C' || c_custkey AS id, 'nodes ' || c_mktsegment AS part, c_name AS value FROM customer
UNION ALL SELECT 'O' || o_orderkey, 'edges ' || o_orderstatus, 'C' || o_custkey FROM orders""")
def queue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of several labels and edges of several types as queue documents, written and read."""
    path = shared_dir(spark, "queue")
    nodes = table(spark, sf_dir, "customer").select(_text("C", F.col("c_custkey")).alias("id"), F.col("c_mktsegment").alias("label"), F.col("c_name").alias("name"))
    edges = table(spark, sf_dir, "orders").select(_text("O", F.col("o_orderkey")).alias("src"), _text("C", F.col("o_custkey")).alias("dst"), F.col("o_orderstatus").alias("type"))
    sinks.write_documents(nodes, edges, path, "shop")
    read = spark.read.schema("id string, name string, label string").json(f"{path}/command=shop/nodes")
    met = spark.read.schema("src string, dst string, type string").json(f"{path}/command=shop/edges")
    return read.select("id", _text("nodes ", F.col("label")).alias("part"), F.col("name").alias("value")).unionByName(
        met.select(F.col("src").alias("id"), _text("edges ", F.col("type")).alias("part"), F.col("dst").alias("value"))
    )


@query("SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20' - 7")
def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of days that are older than what is kept; other names stay."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("day")).distinct()
    return sinks.expired(days.unionByName(spark.createDataFrame([("latest",)], "day string")), "day", "2024-01-20", 7)


@query("""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'skipped' WHEN page_id % 2 = 0 THEN 'duplicate' ELSE 'success' END AS status FROM pages""")
def publication_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles without a summary, already published, or to publish."""
    key = F.col("page_id")
    p = table(spark, sf_dir, "pages")
    articles = p.select("page_id", _text(SITE, "/", key, "#top").alias("url"), F.when(key % 3 == 0, " ").otherwise("said").alias("summary"))
    published = p.where("page_id % 2 = 0").select(_text("https://www.NEWS.example.com/", key, "?utm_source=x").alias("url"))
    out = sessions.publish_status(articles, published)
    return out.select(F.regexp_extract("url", r"/(\d+)#", 1).cast("long").alias("page_id"), "status")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'x' || o_orderkey END AS a, o_orderpriority AS b, 2 AS n_previews, 'answer 0 of ' || o_orderkey AS first_preview FROM orders""")
def flattened_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse maps, flattened structs and previews of answers."""
    key = F.col("o_orderkey")
    nested = table(spark, sf_dir, "orders").select("o_orderkey", F.struct(F.struct(F.when(key % 2 == 0, _text("x", key)).otherwise(" ").alias("a"), F.col("o_orderpriority").alias("b")).alias("in")).alias("out"))
    flat = records.flattened(nested)
    sparse = records.sparse_map({"a": F.col("`out.in.a`"), "b": F.col("`out.in.b`")})
    answers = records.previews(F.array(_text("answer 0 of ", key), F.lit("  "), F.repeat(F.lit("y"), F.lit(300))))
    return flat.select("o_orderkey", sparse.alias("m"), answers.alias("p")).select(
        "o_orderkey", F.try_element_at("m", F.lit("a")).alias("a"), F.try_element_at("m", F.lit("b")).alias("b"), F.size("p").alias("n_previews"), F.col("p")["chat_answer_0_preview"].alias("first_preview")
    )
