"""Queries on pages: lists by selectors, tables by cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finloom.plans.catalog import query
from finloom.session import table
from finloom.sources import markup, page_lists

SITE = "https://news.example.com"
NOW = "2024-01-01 00:00:00"
_MENU = """SELECT page_id, regexp_extract(url, '^https?://[^/?#]*') AS site,
  unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="[^"]*">[^<]*')) AS link,
  generate_subscripts(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="[^"]*">[^<]*'), 1) - 1 AS row FROM pages"""


def _html(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


@query(f"SELECT page_id, CAST(row AS INTEGER) AS row, site || regexp_extract(link, '\"([^\"]*)\"', 1) AS url FROM ({_MENU})")
def page_menu_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the menus of all pages, made absolute."""
    return page_lists.links(table(spark, sf_dir, "pages"), "page_id", "html", "url", "nav a")


@query(f"""
WITH m AS (SELECT page_id, row, trim(split_part(link, '>', 2)) AS title, site || regexp_extract(link, '"([^"]*)"', 1) AS url FROM ({_MENU})),
f AS (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY row) AS again FROM m WHERE title <> ''),
k AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY row) AS place FROM f WHERE again = 1)
SELECT page_id, CAST(row AS INTEGER) AS row, title, url, CAST(NULL AS VARCHAR) AS date FROM k WHERE place <= 4""")
def page_menu_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four different entries of the menu of every page as articles."""
    return page_lists.article_rows(table(spark, sf_dir, "pages"), "page_id", "html", "url", "body > nav li", "li > a", date="time.day", most=4)


@query("""
WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)(?:</article>|$)', 1) AS x FROM pages),
p AS (SELECT page_id, unnest(string_split(x, '<p>')[2:]) AS t, generate_subscripts(string_split(x, '<p>')[2:], 1) - 1 AS row FROM a)
SELECT page_id, CAST(row AS INTEGER) AS row, CAST(length(s) AS INTEGER) AS n_chars, sha256(s) AS sha256 FROM
  (SELECT page_id, row, replace(replace(replace(replace(replace(regexp_replace(regexp_extract(t, '(?s)^(.*?)(?:</p>|$)', 1), '<[^>]*>', '', 'g'),
    '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS s FROM p)""")
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of the articles of pages; markup often leaves their ends out."""
    found = markup.select_rows(table(spark, sf_dir, "pages"), "page_id", "html", "article p", {"text": markup.Field(":scope")})
    text = F.get("text", 0)
    return found.select("page_id", "row", F.length(text).alias("n_chars"), F.sha2(text, 256).alias("sha256"))


def _customer_pages(spark: SparkSession, sf_dir: str, row: Column, head: str, tail: str) -> DataFrame:
    """A page for every customer, with a row for every order."""
    rows = F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("h"))))
    body = F.array_join(F.transform(rows, lambda r: r["h"]), "\n")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(_html(head, body, tail).alias("html"))


_PLACE = "CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER)"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


@query(f"""
SELECT o_custkey, {_PLACE} AS row, o_orderstatus, 'Order ' || o_orderkey || ' & ' || o_orderpriority AS title,
  CASE WHEN o_orderstatus = 'P' THEN '{SITE}' ELSE '{SITE}/n/' || o_orderkey END AS url,
  CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'F' THEN CAST({_DAY} || ' 00:00:00' AS TIMESTAMP) ELSE TIMESTAMP '{NOW}' END AS published, o_orderpriority AS kind
FROM orders""")
def news_table_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a news table, read back as articles."""
    status, day = F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd")
    at = F.when((status == "F") & (F.col("o_totalprice") > 100000), _html("<time datetime='", day, "T09:00:00+09:00'>x</time>")).when(status == "O", '<time datetime="soon">').otherwise("")
    link = F.when(status == "P", "<a>").otherwise(_html('<a class=x href="/n/', F.col("o_orderkey"), '">'))
    row = _html(
        "<tr><td class='news_time'>", at, "<td><div class='newslist_ctg ", status, "'> ", F.col("o_orderpriority"), " </div>more<td>", link,
        " Order ", F.col("o_orderkey"), " &amp; ", F.col("o_orderpriority"), " <b>new</b></a>",
    )
    pages = _customer_pages(spark, sf_dir, row, "<table><tr><td>1<td>2<td><a href=/no>no</a></table><table class='a s_news_list'><tr><th>time<th>kind<th>title</tr>", "</table><p>end")
    found = page_lists.news_table_rows(pages, "o_custkey", "html", SITE, F.lit(NOW).cast("timestamp"))
    number = F.regexp_extract("title", r"Order (\d+)", 1).cast("long")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    return found.join(orders, number == F.col("k")).drop("k")


@query(f"""
WITH f AS (SELECT o_custkey, 'Day ' || {_DAY} AS title, '{SITE}/news/' || strftime(o_orderdate, '%Y%m%d') AS url, min(o_orderkey) AS first,
  min(o_orderdate) AS day FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY first) AS place FROM f)
SELECT o_custkey, title, url, CAST(strftime(day, '%Y-%m-%d') || ' 00:30:00' AS TIMESTAMP) AS published FROM k WHERE place <= 5""")
def linked_news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of orders as list items that link to news: the first five of every customer."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    address = _html("/news/", F.date_format("o_orderdate", "yyyyMMdd"))
    item = _html(
        "<li><a href='/news/search'><h3>all</h3></a><a href='", address, "'><time datetime='", day, "T09:30:00'><h3>time</h3></time><h3>Day ", day, "</h3><span>x</span></a>"
    )
    row = F.when(F.col("o_orderstatus") == "P", _html("<li><a href='", address, "?p'><h3>none</h3></a>")).otherwise(item)
    pages = _customer_pages(spark, sf_dir, row, "<ul><li><a href='/news/topics'>topics</a></ul><ul>", "</ul>")
    return page_lists.link_items(pages, "o_custkey", "html", SITE, F.lit(NOW).cast("timestamp"), 5).drop("row")


@query(f"""
SELECT o_custkey, CAST({_PLACE} - 1 AS INTEGER) AS row, 'Order ' || o_orderkey AS title, '{SITE}/' || CASE WHEN o_orderstatus = 'O' THEN 'own' ELSE 'inner' END || '/' || o_orderkey AS url,
  CAST({_DAY} AS TIMESTAMP) AS published, 'markets' AS category FROM orders""")
def section_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cards of a section's page, with the link inside or on the card."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    start = F.when(status == "O", _html("<a data-testid='BasicCard' href='/own/", key, "'>")).otherwise("<div data-testid=HeroCard>")
    inner = F.when(status == "O", "").otherwise(_html("<div data-testid='Title'><a>x</a><a href='", SITE, "/inner/", key, "'>go</a></div>"))
    end = F.when(status == "O", "</a>").otherwise("</div>")
    row = _html(start, inner, "<h3 data-testid='Heading'><span> Order ", key, "</span></h3><time dateTime='", F.date_format("o_orderdate", "yyyy-MM-dd"), "T00:00:00Z'></time>", end)
    pages = _customer_pages(spark, sf_dir, row, "", "<div data-testid='BasicCard'><h3 data-testid='Heading'>no link</h3></div>")
    return page_lists.cards(pages, "o_custkey", "html", "markets", SITE, F.lit(NOW).cast("timestamp"))


@query(f"""
SELECT o_custkey, CAST({_PLACE} - 1 AS INTEGER) AS row, '{SITE}/c/' || o_custkey || '/' || o_orderkey || CASE WHEN o_orderstatus = 'F' THEN '.PDF?x' ELSE '' END AS url,
  'Report ' || o_orderkey AS title, TIMESTAMP '{NOW}' AS published,
  CASE o_orderstatus WHEN 'F' THEN '{SITE}/c/' || o_custkey || '/' || o_orderkey || '.PDF?x' WHEN 'O' THEN '{SITE}/f/' || o_orderkey || '.pdf' END AS pdf_url, ['report', 'orders'] AS tags FROM orders""")
def report_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reports of a list, with a PDF of their own, beside them or none."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    beside = F.when(status == "O", _html("<i href='/x.html'></i><i href='/f/", key, ".pdf'></i><i href='/g.pdf'></i>")).otherwise("")
    row = _html("<a class='report' href='", key, F.when(status == "F", ".PDF?x").otherwise(""), "'>Report ", key, " <b>new</b>", beside, "</a>")
    pages = _customer_pages(spark, sf_dir, row, "<a class='report'>no link</a><a class='report' href='/n'><b>no text</b></a>", "")
    pages = pages.withColumn("base", _html(SITE, "/c/", F.col("o_custkey"), "/list?page=1"))
    found = page_lists.report_items(pages, "o_custkey", "html", "base", "a.report", ("report", "orders"), F.lit(NOW).cast("timestamp"), pdf="i")
    return found.withColumn("row", F.col("row") - 2)


_ITEMS = "SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS place, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem"


@query(f"""
WITH i AS ({_ITEMS}),
o AS (SELECT l_orderkey, o_custkey, max(n) AS n, sum(max(n)) OVER (PARTITION BY o_custkey ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM i JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
c AS (SELECT o_custkey, i.*, coalesce(before, 0) + 1 + place AS row FROM i JOIN o USING (l_orderkey))
SELECT o_custkey, CAST(row AS INTEGER) AS row, 0 AS col, l_orderkey::VARCHAR AS value, CAST(n AS INTEGER) AS rowspan, 1 AS colspan, 'order' AS label FROM c WHERE place = 1
UNION ALL SELECT o_custkey, CAST(row AS INTEGER), 1, CAST(l_linenumber AS VARCHAR), 1, 1, 'line / number' FROM c
UNION ALL SELECT o_custkey, CAST(row AS INTEGER), 2, CAST(l_quantity AS INTEGER) || ' & ' || l_returnflag, 1, CASE WHEN l_returnflag = 'N' THEN 2 ELSE 1 END, 'line / amount' FROM c
UNION ALL SELECT o_custkey, CAST(row AS INTEGER), 3, l_linestatus, 1, 1, 'status' FROM c WHERE l_returnflag <> 'N'""")
def order_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as a table with spans in head and body, taken apart again."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    lines = table(spark, sf_dir, "lineitem").withColumn("place", place).withColumn("n", F.count("*").over(Window.partitionBy("l_orderkey")))
    both = lines.join(table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    returned = F.col("l_returnflag") == "N"
    row = _html(
        "<tr>", F.when(F.col("place") == 1, _html("<th rowspan='", F.col("n"), "'>", F.col("l_orderkey"), "</th>")).otherwise(""), "<td>", F.col("l_linenumber"),
        F.when(returned, "<td colspan=2>").otherwise("<td>"), " ", F.col("l_quantity").cast("int"), "\n&amp; <b>", F.col("l_returnflag"), "</b>", F.when(returned, "").otherwise(_html("<td>", F.col("l_linestatus"))),
    )
    rows = F.sort_array(F.collect_list(F.struct("l_orderkey", "place", row.alias("h"))))
    head = "<p>text<table><thead><tr><th rowspan=2>order<th colspan=2>line<th rowspan=0>status<tr><th>number<th>amount</thead><tbody>"
    pages = both.groupBy("o_custkey").agg(_html(head, F.array_join(F.transform(rows, lambda r: r["h"]), "\n"), "</table>").alias("html"))
    cells = markup.page_tables(pages, "o_custkey", "html")
    return cells.where("row > 1").select("o_custkey", "row", "col", "value", "rowspan", "colspan", "label")


@query("""
WITH c AS (SELECT l_orderkey, list({'row': CAST(l_linenumber AS INTEGER), 'col': CAST(l_quantity AS INTEGER), 'value': l_returnflag || CAST(l_partkey AS VARCHAR), 'rowspan': 1, 'colspan': greatest(1, CAST(l_linenumber AS INTEGER) - 3)}
  ORDER BY l_linenumber) FILTER (l_returnflag <> 'R') AS cells FROM lineitem GROUP BY 1),
e AS (SELECT l_orderkey, unnest(coalesce(cells, [{'row': 0, 'col': 0, 'value': '', 'rowspan': 1, 'colspan': 1}])) AS c FROM c)
SELECT l_orderkey, c.row AS row, c.col AS col, c.value AS value, c.rowspan AS rowspan, c.colspan AS colspan FROM e""")
def detected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as raw cells of detected tables: bad ones go, a table is never empty."""
    number = F.col("l_linenumber")
    place = F.when(F.col("l_returnflag") == "R", "none").otherwise(number.cast("string"))
    cell = F.struct(place.alias("row"), F.col("l_quantity").cast("int").cast("string").alias("col"), _html(F.col("l_returnflag"), F.col("l_partkey")).alias("text"), F.lit(None).cast("string").alias("rowspan"), F.greatest(F.lit(0), number - 3).cast("string").alias("colspan"))
    raw = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return raw.select("l_orderkey", F.inline(markup.converted_cells("cells")))
