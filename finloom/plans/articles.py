"""Queries of publishers' documents: JSON, feeds, sitemaps, files.

The documents are built from the tables, so that SQL can tell from the tables
what must be read from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom import sinks
from finloom.functions import dates
from finloom.plans.catalog import query
from finloom.session import table
from finloom.sources import documents as docs
from finloom.sources import files, listings
from finloom.storage import shared_dir

SITE = "https://news.example.com"


def _every(n: int) -> Column:
    return F.col("o_orderkey") % n == 0


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as news of a ticker in JSON; some lack what they must have."""
    key = F.col("o_orderkey")
    body = F.struct(
        F.struct(
            F.when(~_every(7), _text(" Order ", key, " ")).alias("title"),
            F.when(~_every(11), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon").alias("pubDate"),
            F.when(_every(2), _text("about ", key)).alias("summary"),
            F.when(_every(5), "VIDEO").when(_every(3), "STORY").when(_every(2), "OTHER").alias("contentType"),
            F.struct(F.when(~_every(13), _text(SITE, "/", key)).otherwise("nowhere").alias("url"), F.col("o_orderpriority").alias("region"), F.lit("en").alias("lang")).alias("canonicalUrl"),
            F.struct(F.when(_every(3), F.col("o_orderstatus")).alias("displayName"), F.lit(SITE).alias("url")).alias("provider"),
            F.struct(F.when(_every(4), _text(SITE, "/p.png")).alias("originalUrl"), F.lit(640).alias("originalWidth")).alias("thumbnail"),
            F.struct(_every(6).alias("editorsPick")).alias("metadata"),
        ).alias("content")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("ticker"), F.to_json(body).alias("raw"))


_NEWS_SQL = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN '{SITE}/' || o_orderkey ELSE 'nowhere' END AS url, CASE WHEN o_orderkey % 7 <> 0 THEN 'Order ' || o_orderkey END AS title,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 5 = 0 THEN 'video' WHEN o_orderkey % 3 = 0 THEN 'article' ELSE 'unknown' END AS content_type,
  CASE WHEN o_orderkey % 2 = 0 THEN 'about ' || o_orderkey END AS summary, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS provider, CASE WHEN o_orderkey % 4 = 0 THEN 640 END AS width,
  o_orderstatus AS ticker, o_orderpriority AS region, CASE WHEN o_orderkey % 6 = 0 THEN 'true' ELSE 'false' END AS picked,
  CASE WHEN o_orderkey % 13 = 0 THEN 'url' WHEN o_orderkey % 7 = 0 THEN 'title' WHEN o_orderkey % 11 = 0 THEN 'published' END AS error FROM orders"""


@query(f"SELECT o_orderkey, url, title, day, content_type, summary, provider, width, ticker, region, picked FROM ({_NEWS_SQL}) WHERE error IS NULL")
def ticker_news_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid articles from a ticker's news."""
    found = listings.ticker_articles(_news(spark, sf_dir), "raw", "ticker").where("error IS NULL")
    return found.select(
        "o_orderkey", "url", "title", F.to_date("published").alias("day"), "content_type", "summary", F.col("provider.name").alias("provider"), F.col("thumbnail.width").alias("width"),
        F.element_at("related_tickers", 1).alias("ticker"), F.col("metadata")["region"].alias("region"), F.col("metadata")["editors_pick"].alias("picked"),
    )


@query(f"SELECT error, count(*) AS n FROM ({_NEWS_SQL}) WHERE error IS NOT NULL GROUP BY 1")
def invalid_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What invalid articles lack."""
    return listings.ticker_articles(_news(spark, sf_dir), "raw", "ticker").where("error IS NOT NULL").groupBy("error").agg(F.count("*").alias("n"))


@query(f"SELECT o_orderkey, url, ticker AS tag, ticker AS search_query, 0 AS n_tickers FROM ({_NEWS_SQL}) WHERE error IS NULL")
def search_news_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid articles found by a query."""
    found = listings.search_articles(_news(spark, sf_dir), "raw", "ticker").where("error IS NULL")
    return found.select("o_orderkey", "url", F.element_at("tags", 1).alias("tag"), F.col("metadata")["search_query"].alias("search_query"), F.size("related_tickers").alias("n_tickers"))


@query(f"""
WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, o_orderdate, o_orderpriority FROM orders),
v AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY pos) AS place FROM r WHERE o_orderkey % 7 <> 0 AND o_custkey % 4 < 3)
SELECT o_custkey, CAST(pos AS INTEGER) AS pos, 'Order ' || o_orderkey AS title, '{SITE}/' || o_orderkey AS url,
  CASE WHEN o_orderkey % 5 = 0 THEN DATE '2024-01-01' ELSE o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 2 = 0 THEN repeat('x', 497) || '...' ELSE 'short' END AS summary
FROM v WHERE place <= 5""")
def listing_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five valid rows of every customer's listing, whose shape and names vary."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    title, address = F.when(~_every(7), _text(" Order ", key)), _text(F.when(_every(3), SITE).otherwise(""), "/", key)
    row = F.struct(
        F.when(_every(2), title).otherwise("").alias("title"), F.when(~_every(2), title).alias("headline"), address.alias("link"),
        F.when(_every(5), "soon").when(_every(2), F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("created"),
        F.when(_every(2), F.repeat(F.lit("x"), F.lit(501))).otherwise("short").alias("body"),
    )
    rows = o.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("r")))), lambda x: x["r"]).alias("rows"))
    shape = F.col("o_custkey") % 3
    body = F.when(shape == 0, F.to_json(F.struct(F.struct("rows").alias("data")))).when(shape == 1, F.to_json(F.struct(F.col("rows").alias("data")))).otherwise(F.to_json(F.struct("rows")))
    raw = rows.select("o_custkey", F.when(F.col("o_custkey") % 4 < 3, "markets").otherwise("unknown").alias("category"), body.alias("raw"))
    found = listings.listing_articles(raw, "raw", "category", ("markets",), SITE, 5, F.lit("2024-01-01").cast("timestamp"))
    return found.select("o_custkey", "pos", "title", "url", F.to_date("published").alias("day"), "summary")


@query(f"""
SELECT p_partkey, p_name AS title, '{SITE}/' || p_partkey AS url, CASE WHEN p_partkey % 3 = 0 THEN DATE '2020-02-02' ELSE DATE '2024-01-01' END AS day, p_brand AS author, 3 AS n_tags
FROM part WHERE p_partkey % 5 <> 0""")
def listed_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as reports in JSON lists, those without a title left out."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    item = F.struct(
        F.when(key % 5 == 0, "").otherwise(F.concat("p_name", F.lit(" "))).alias("title"), F.when(key % 2 == 0, _text("/", key)).otherwise(_text(SITE, "/", key)).alias("url"),
        F.when(key % 3 == 0, "2020-02-02").when(key % 3 == 1, "tomorrow").alias("date"), F.when(key % 2 == 0, F.col("p_brand")).alias("authors"), F.when(key % 2 == 1, F.col("p_brand")).alias("author"),
    )
    raw = p.select("p_partkey", F.to_json(F.array(item)).alias("raw"))
    found = listings.listed_reports(raw, "raw", SITE, F.lit("2024-01-01").cast("timestamp"))
    return found.select("p_partkey", "title", "url", F.to_date("published").alias("day"), "author", F.size("tags").alias("n_tags"))


@query("""
WITH a AS (SELECT o_custkey, count(*) AS n, string_agg(CASE WHEN o_orderkey % 3 = 0 THEN 'Unknown' ELSE o_orderpriority END, ',' ORDER BY o_orderkey) AS names FROM orders GROUP BY 1)
SELECT c_custkey, c_name AS title, coalesce(n, 0) AS n_authors, coalesce(names, '') AS authors, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS n_references,
  CASE WHEN c_custkey % 2 = 0 THEN 'a' || c_custkey END AS cited, 0 AS n_citations FROM customer LEFT JOIN a ON o_custkey = c_custkey""")
def paper_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as papers in JSON with orders as authors; lists may be null."""
    author = F.struct("o_orderkey", F.when(~_every(3), F.col("o_orderpriority")).alias("name"))
    authors = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.transform(F.array_sort(F.collect_list(author)), lambda x: F.struct(x["name"].alias("name"))).alias("authors"))
    reference = F.struct(F.lit(None).cast("string").alias("title"), F.struct(_text("a", F.col("c_custkey")).alias("ArXiv")).alias("externalIds"))
    c = table(spark, sf_dir, "customer").join(authors, "c_custkey", "left")
    raw = c.select("c_custkey", F.to_json(F.struct(F.col("c_name").alias("title"), "authors", F.when(F.col("c_custkey") % 2 == 0, F.array(reference)).alias("references"))).alias("raw"))
    p = listings.papers(raw, "c_custkey", "raw")
    return p.select(
        "c_custkey", "title", F.size("authors").cast("long").alias("n_authors"), F.array_join("authors.name", ",").alias("authors"), F.size("references").alias("n_references"),
        F.try_element_at("references.arxiv_id", F.lit(1)).alias("cited"), F.size("citations").alias("n_citations"),
    )


@query("""
WITH n AS (SELECT user_id AS key, arg_max(event_id, (ts, event_id)) AS value, max(ts) AS "at" FROM events GROUP BY 1)
SELECT key, value FROM n WHERE n."at" >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 DAY""")
def cached_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' last events as cache entries that live for a day."""
    entries = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("value"), F.col("ts").cast("timestamp").alias("created_at"))
    return listings.cached(entries, F.lit("2024-01-30 12:00:00").cast("timestamp"), 86_400).select("key", "value")


@query("""
WITH w AS (SELECT o_orderkey AS pos, o_custkey AS id FROM orders), c AS (SELECT *, CASE WHEN id % 3 = 0 THEN 'c' || id END AS value FROM w),
a AS (SELECT pos, id, row_number() OVER (ORDER BY pos) AS number FROM c WHERE value IS NULL)
SELECT pos, id, value, 'cache' AS origin FROM c WHERE value IS NOT NULL
UNION ALL SELECT pos, id, 'b' || number, 'batch' FROM a WHERE number % 4 <> 0 UNION ALL SELECT pos, id, 's' || id, 'single' FROM a WHERE number % 4 = 0 AND id % 2 = 0""")
def papers_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids looked up in a cache, then by their place in a batch answer, then one by one."""
    wanted = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("id"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    cache = known.where("id % 3 = 0").select(F.col("id").alias("key"), _text("c", F.col("id")).alias("value"))
    n = table(spark, sf_dir, "orders").count()
    batch = spark.range(1, n + 1).select(F.col("id").alias("number"), F.when(F.col("id") % 4 != 0, _text("b", F.col("id"))).alias("value"))
    return listings.resolved_papers(wanted, cache, batch, known.where("id % 2 = 0").select("id", _text("s", F.col("id")).alias("value")))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as CSV and read back as a sheet: text under its header."""
    path = shared_dir(spark, "sheet")
    sinks.write_csv(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), path)
    return listings.read_sheet(spark, path)


@query(f"""
SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS pos, 'A & B ' || o_orderkey AS title, '{SITE}/' || o_orderkey AS link,
  CASE WHEN o_orderkey % 4 < 3 THEN o_orderdate::DATE END AS day, o_orderpriority AS summary FROM orders""")
def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as RSS documents, dated in two ways or not at all."""
    key = F.col("o_orderkey")
    day = F.when(key % 4 == 0, F.concat(F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(key % 4 == 3, "later").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    item = _text("<item><title>A &amp; B ", key, f"</title><link>{SITE}/", key, "</link><pubDate>", day, "</pubDate><description>", F.col("o_orderpriority"), "</description></item>")
    feeds = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", item.alias("i")))).alias("x"))
    feeds = feeds.select("o_custkey", _text("<rss><channel><title>t</title>", F.array_join(F.transform("x", lambda x: x["i"]), ""), "</channel></rss>").alias("xml"))
    return docs.feed_items(feeds, "o_custkey", "xml").select("o_custkey", "pos", "title", "link", F.to_date("published").alias("day"), "summary")


@query(f"""
SELECT p_brand, '{SITE}/' || p_partkey AS loc, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS lastmod, CASE WHEN p_partkey % 3 = 0 THEN CAST(0.5 AS DOUBLE) END AS priority FROM part""")
def sitemap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a brand as a sitemap; a priority may be no number."""
    key = F.col("p_partkey")
    entry = _text(f"<url><loc>{SITE}/", key, "</loc>", F.when(key % 2 == 0, _text("<lastmod>", F.col("p_type"), "</lastmod>")).otherwise(""), "<priority>", F.when(key % 3 == 0, "0.5").otherwise("high"), "</priority></url>")
    maps = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.collect_list(entry), "").alias("urls"))
    return docs.sitemap_entries(maps.select("p_brand", _text("<urlset>", F.col("urls"), "</urlset>").alias("xml")), "p_brand", "xml").select("p_brand", "loc", "lastmod", "priority")


@query("""
SELECT 'root' AS url UNION ALL SELECT 'R' || r_regionkey FROM region UNION ALL SELECT 'N' || n_nationkey FROM nation UNION ALL SELECT 'S' || s_suppkey FROM supplier""")
def sitemap_index_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemaps that an index reaches in three steps; a fourth is too far."""
    index = lambda c: _text("<sitemapindex>", F.array_join(F.transform(c, lambda u: F.concat(F.lit("<sitemap><loc>"), u, F.lit("</loc></sitemap>"))), ""), "</sitemapindex>")
    t = lambda name: table(spark, sf_dir, name)
    level = lambda df, parent, child: df.groupBy(parent.alias("url")).agg(F.collect_list(child).alias("c")).select("url", index(F.col("c")).alias("content"))
    maps = level(t("region"), F.lit("root"), _text("R", F.col("r_regionkey")))
    maps = maps.unionByName(level(t("nation"), _text("R", F.col("n_regionkey")), _text("N", F.col("n_nationkey"))))
    below = level(t("supplier"), _text("N", F.col("s_nationkey")), _text("S", F.col("s_suppkey")))
    nations = t("nation").select(_text("N", F.col("n_nationkey")).alias("url")).join(below, "url", "left").select("url", F.coalesce("content", F.lit("<urlset/>")).alias("content"))
    leaves = level(t("supplier"), _text("S", F.col("s_suppkey")), _text("far", F.col("s_suppkey")))
    regions = t("region").select(_text("R", F.col("r_regionkey")).alias("url")).join(maps.select("url"), "url", "left_anti").withColumn("content", F.lit("<urlset/>"))
    far = t("supplier").select(_text("far", F.col("s_suppkey")).alias("url"), F.lit("<urlset/>").alias("content"))
    return docs.sitemap_tree(maps.unionByName(regions).unionByName(nations).unionByName(leaves).unionByName(far), "root")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'no' WHEN s_suppkey % 3 = 0 THEN 'yes' END AS training, CASE WHEN s_suppkey % 5 = 0 THEN 'all' END AS noai FROM supplier""")
def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directives for crawlers of language models; the last of a key holds."""
    key = F.col("s_suppkey")
    text = F.concat_ws(
        "\n", F.lit("User-agent: *"), F.when(key % 3 == 0, "AI-Training: yes"), F.when(key % 2 == 0, " ai-training : no "), F.when(key % 5 == 0, "noai: all"), F.lit("Disallow: /private")
    )
    found = table(spark, sf_dir, "supplier").select("s_suppkey", docs.robots_directives(text).alias("m"))
    return found.select("s_suppkey", F.try_element_at("m", F.lit("ai-training")).alias("training"), F.try_element_at("m", F.lit("noai")).alias("noai"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN o_orderdate::DATE ELSE DATE '2024-01-01' END AS listed, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE END AS japanese,
  strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS zoned, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::DATE ELSE (o_orderdate - INTERVAL 9 HOUR)::DATE END AS local FROM orders""")
def publisher_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as publishers write them, read again."""
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    listed = F.when(key % 5 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).when(key % 5 == 1, F.date_format(at, "yyyy-MM-dd")).when(key % 5 == 2, F.date_format(at, "MMM d, yyyy")).when(key % 5 == 3, F.date_format(at, "MM/dd/yyyy")).otherwise("soon")
    japanese = F.when(key % 3 == 0, F.concat(F.date_format(at, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000"))).when(key % 3 == 1, F.date_format(at, "yyyy'年'M'月'd'日'")).otherwise("近日")
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date(dates.parse_formats(listed, F.lit("2024-01-01").cast("timestamp"))).alias("listed"),
        F.to_date(dates.parse_japanese(japanese)).alias("japanese"),
        dates.in_zone(F.concat(iso, F.lit("Z"))).alias("zoned"),
        F.to_date(dates.parse_local(F.when(key % 2 == 0, F.concat(iso, F.lit("Z"))).otherwise(iso))).alias("local"),
    )


@query("""
WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN 'again' ELSE 'turn ' || turn || ' <b>' END AS said FROM conversations),
c AS (SELECT conv_id, turn, CASE WHEN said = 'again' THEN 'again' ELSE 'turn ' || turn END AS text FROM t UNION ALL SELECT conv_id, turn, 'end' FROM t WHERE turn % 3 = 2),
o AS (SELECT *, CASE WHEN text = 'end' THEN 2 * turn + 1 ELSE 2 * turn END AS i FROM c)
SELECT conv_id, CAST(i * 2.5 AS DOUBLE) AS start, text FROM (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o) WHERE before IS DISTINCT FROM text""")
def caption_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as captions: tags go, and a cue equal to the one before it."""
    stamp = lambda s: F.concat(F.lpad(F.floor(s / 3600).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.floor(s % 3600 / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.format_string("%.3f", s % 60), 6, "0"))
    cue = lambda i, text: F.concat(stamp(i * 2.5), F.lit(" --> "), stamp(i * 2.5 + 2.0), F.lit("\n"), text)
    i = (F.col("turn") * 2).cast("double")
    again = F.col("turn") % 3 == 2
    cues = F.array_compact(F.array(cue(i, F.when(again, "again").otherwise(_text("<c>turn  ", F.col("turn"), "</c>"))), F.when(again, cue(i, F.lit("again"))), F.when(again, cue(i + 1, F.lit("end")))))
    said = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", cues.alias("c")))).alias("x"))
    text = F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.flatten(F.transform("x", lambda x: x["c"])), "\n\n"))
    return docs.caption_cues(said.select("conv_id", text.alias("vtt")), "conv_id", "vtt").select("conv_id", "start", "text")


@query(f"SELECT page_id, '{SITE}/r' || page_id || '.PDF?v=1' AS link FROM pages UNION ALL SELECT page_id, '/b.pdf' FROM pages WHERE page_id % 2 = 0")
def pdf_link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to PDF files on pages, each once."""
    key = F.col("page_id")
    html = _text(F.coalesce("html", F.lit("")), f'<a class="x" href="{SITE}/r', key, '.PDF?v=1">r</a><a href="/a.html">a</a>', F.when(key % 2 == 0, "<A HREF='/b.pdf'>b</A><a href=\"/b.pdf\">b</a>").otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(docs.pdf_links(html)).alias("link"))


@query(f"""
WITH n AS (SELECT s_nationkey, s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE '{SITE}/' || (s_suppkey % 50) END AS url FROM supplier)
SELECT url, 'Supplier ' || arg_min(s_suppkey, (lpad(CAST(s_nationkey AS VARCHAR), 3, '0'), s_suppkey)) AS title FROM n WHERE url <> '' GROUP BY 1""")
def raw_article_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of JSON documents as articles, the first of every URL."""
    path = shared_dir(spark, "raw-articles")
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    row = F.struct("s_suppkey", _text("Supplier ", key).alias("title"), F.when(key % 9 == 0, "").otherwise(_text(SITE, "/", key % 50)).alias("url"))
    by_nation = s.groupBy(F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("nation")).agg(F.array_sort(F.collect_list(row)).alias("news"))
    by_nation.repartition("nation").write.partitionBy("nation").json(path)
    return files.raw_articles(spark, path).select("url", "title")


@query("""
SELECT source, block, CAST(sum(strlen(line) + 1) AS BIGINT) AS size, sha256(string_agg(line || chr(10), '' ORDER BY doc_id)) AS sha256
FROM (SELECT doc_id, doc_id // 1000 AS block, 'source=' || replace(coalesce(source, 'none'), ':', '%3A') AS source, doc_id || ' ' || md5(coalesce(text, '')) AS line FROM documents) GROUP BY 1, 2""")
def hashed_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the digests of a thousand documents of a source at most, by the hash of their content."""
    path = shared_dir(spark, "hashed-files")
    line = _text(F.col("doc_id"), " ", F.md5(F.coalesce("text", F.lit(""))))
    rows = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("none")).alias("source"), F.expr("doc_id div 1000").alias("block"), "doc_id", line.alias("value"))
    rows.repartition("source", "block").sortWithinPartitions("source", "block", "doc_id").drop("doc_id").write.partitionBy("source", "block").text(path)
    found = files.hashed_files(spark, path, "part-*")
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path).select(F.col("path").alias("file"), F.col("length").alias("size"))
    return found.select("file", "sha256").join(sizes, "file").select(F.regexp_extract("file", "/(source=[^/]+)/", 1).alias("source"), F.regexp_extract("file", r"/block=(\d+)/", 1).cast("long").alias("block"), "size", "sha256")


@query(f"""
SELECT '{SITE}/' || source || '/' || block AS url, 'Report: ' || source || ', part ' || block AS title, CAST(count(*) AS INTEGER) AS n_sections, max(len(d)) AS longest
FROM (SELECT source, doc_id // 1000 AS block, doc_id || repeat('!', CAST(doc_id % 7 AS INTEGER)) AS d FROM documents WHERE source >= 'src2') GROUP BY source, block""")
def markdown_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of a thousand ids of a source as markdown files, a section for each document;
    some sources leave the URL in the front matter empty, no source means no front matter."""
    path = shared_dir(spark, "markdown")
    level = F.repeat(F.lit("#"), (F.col("doc_id") % 6 + 1).cast("int"))
    section = _text(level, " ", F.col("doc_id"), F.repeat(F.lit("!"), (F.col("doc_id") % 7).cast("int")), "\n#", F.md5(F.coalesce("text", F.lit(""))), "\n")
    rows = table(spark, sf_dir, "documents").select("source", F.expr("doc_id div 1000").alias("block"), section.alias("section"))
    # A file is a thousand sections at most.
    body = F.array_join(F.collect_list("section"), "")
    address = F.when(F.col("source") < "src2", "").otherwise(_text(SITE, "/", F.col("source"), "/", F.col("block")))
    front = _text('---\ntitle: "Report: ', F.col("source"), ", part ", F.col("block"), '"\nurl: ', address, "\n---\n")
    found = rows.groupBy("source", "block").agg(body.alias("body"))
    found = found.select(F.xxhash64("source", "block").alias("key"), _text(F.coalesce(front, F.lit("")), F.col("body")).alias("value")).repartition("key")
    found.write.option("lineSep", "\u0001").partitionBy("key").text(path)
    heads = lambda s: F.transform(s, lambda x: F.length(docs.section_heading(x)))
    read = files.markdown_sources(spark, path, "part-*")
    return read.select("url", "title", F.size(F.filter("sections", lambda s: s.startswith("#"))).alias("n_sections"), F.array_max(heads(F.col("sections"))).cast("long").alias("longest"))


@query("""
SELECT page_id, 'Title ' || page_id || chr(10) || 'Body & more of ' || url AS text FROM pages WHERE page_id % 3 > 0
UNION ALL SELECT page_id, 'menu' || chr(10) || 'plain ' || page_id FROM pages WHERE page_id % 3 = 0""")
def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the articles of pages, or of all that a page shows without one."""
    key = F.col("page_id")
    address = F.replace(F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    article = _text("<article><h1> Title  ", key, "</h1><script>var a = '<p>no</p>';</script><p>Body &amp; more of ", address, "</p></article>")
    html = _text("<html><head><style>p{}</style></head><body><div>menu</div>", F.when(key % 3 > 0, article).otherwise(_text("<p>plain ", key, "</p>")), "<noscript>none</noscript></body></html>")
    return table(spark, sf_dir, "pages").select("page_id", docs.article_text(html).alias("text"))


@query("""
SELECT c_nationkey AS nation, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS pos, c_custkey AS id, c_name AS title, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
FROM customer WHERE c_nationkey <> 3""")
def json_store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of JSON documents in folders, a document a nation; broken ones give no rows."""
    path = shared_dir(spark, "json-store")
    item = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    documents = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.to_json(F.struct(F.lit("1.0").alias("version"), F.array_sort(F.collect_list(item)).alias("items"))).alias("json"))
    broken = documents.withColumn("json", F.when(F.col("nation") == 3, F.concat(F.lit("["), "json")).otherwise(F.regexp_replace("json", ",", ",\n ")))
    broken.repartition("nation").write.partitionBy("nation").text(path)
    found = docs.read_json_rows(spark, path, "version string, items array<struct<id:long,title:string,balance:double>>", "items")
    return found.select(F.regexp_extract("file", r"nation=(\d+)", 1).cast("int").alias("nation"), "pos", "id", "title", "balance")
