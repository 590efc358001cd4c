"""Articles, reports and papers as publishers' JSON delivers them.

Raw documents are strings in a column.  A document that is no JSON has no rows,
or an error where rows that fail are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions import dates, url
from finloom.functions.records import sparse_map
from finloom.functions.text import truncated
from finloom.operators.dedup import keep_newest

_NEWS = (
    "content struct<title:string,pubDate:string,summary:string,contentType:string,canonicalUrl:struct<url:string,region:string,lang:string>,"
    "provider:struct<displayName:string,url:string>,thumbnail:struct<originalUrl:string,originalWidth:int,originalHeight:int>,"
    "metadata:struct<editorsPick:boolean>,finance:struct<premiumFinance:struct<isPremiumNews:boolean>>>"
)
_ROW = (
    "struct<title:string,headline:string,url:string,link:string,date:string,publishedAt:string,created:string,"
    "summary:string,description:string,body:string>"
)
_PAPER = (
    "title string, abstract string, paperId string, publicationDate string, authors array<struct<name:string,authorId:string>>, "
    "references array<struct<title:string,paperId:string,externalIds:struct<ArXiv:string>>>, "
    "citations array<struct<title:string,paperId:string,externalIds:struct<ArXiv:string>>>"
)
# What publishers call kinds of contents.
CONTENT_TYPES = {"STORY": "article", "VIDEO": "video"}
#: Tags that every listed report has.
REPORT_TAGS = ("macro", "equity", "fixed_income")


def _filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _articles(raw: DataFrame, content: str, source: str, tickers: Column, tags: Column, query: Column) -> DataFrame:
    c = F.col("_news.content")
    address, title, at = c["canonicalUrl"]["url"], F.trim(c["title"]), F.try_to_timestamp(c["pubDate"])
    kind = F.lit("unknown")
    for name, normal in CONTENT_TYPES.items():
        kind = F.when(c["contentType"] == name, normal).otherwise(kind)
    error = (
        F.when(~url.is_web_url(F.coalesce(address, F.lit(""))), "url")
        .when(F.coalesce(title, F.lit("")) == "", "title")
        .when(at.isNull(), "published")
    )
    named = F.nullif(c["provider"]["displayName"], F.lit(""))
    pictured = url.is_web_url(F.coalesce(c["thumbnail"]["originalUrl"], F.lit("")))
    metadata = sparse_map({
        "content_type": c["contentType"], "editors_pick": c["metadata"]["editorsPick"], "is_premium": c["finance"]["premiumFinance"]["isPremiumNews"],
        "region": c["canonicalUrl"]["region"], "lang": c["canonicalUrl"]["lang"], "search_query": query,
    })
    return raw.withColumn("_news", F.from_json(content, _NEWS)).select(
        *[F.col(x) for x in raw.columns if x != content],
        address.alias("url"), title.alias("title"), at.alias("published"), F.lit(source).alias("source"), c["summary"].alias("summary"), kind.alias("content_type"),
        F.when(named.isNotNull(), F.struct(named.alias("name"), F.when(url.is_web_url(c["provider"]["url"]), c["provider"]["url"]).alias("url"))).alias("provider"),
        F.when(pictured, F.struct(c["thumbnail"]["originalUrl"].alias("url"), c["thumbnail"]["originalWidth"].alias("width"), c["thumbnail"]["originalHeight"].alias("height"))).alias("thumbnail"),
        tickers.alias("related_tickers"), tags.alias("tags"), metadata.alias("metadata"), error.alias("error"),
    )


def ticker_articles(raw: DataFrame, content: str, ticker: str) -> DataFrame:
    """News of a ticker as articles; ``error`` names the required field (url,
    title or published) that an invalid one lacks."""
    none = F.array().cast("array<string>")
    return _articles(raw, content, "yfinance_ticker", F.array(ticker), none, F.lit(None).cast("string"))


def search_articles(raw: DataFrame, content: str, query: str) -> DataFrame:
    """News found by a query, which becomes their tag; else as ``ticker_articles``."""
    none = F.array().cast("array<string>")
    return _articles(raw, content, "yfinance_search", none, F.array(query), F.col(query))


def listing_articles(raw: DataFrame, content: str, category: str, categories: Sequence[str], site: str, most: int, now: Column) -> DataFrame:
    """Rows of listings (under data.rows, data.data, data, rows or news) as
    articles: the first ``most`` valid ones of every document of a known
    category.  Each field has several names; a relative URL gets the site, a
    summary of over 500 characters is cut, a date that can't be read is ``now``."""
    nested = F.from_json(content, f"data struct<rows:array<{_ROW}>,data:array<{_ROW}>>, rows array<{_ROW}>, news array<{_ROW}>")
    listed = F.from_json(content, f"data array<{_ROW}>")
    rows = F.coalesce(nested["data"]["rows"], nested["data"]["data"], listed["data"], nested["rows"], nested["news"])
    known = raw.where(F.col(category).isin(*categories))
    flat = known.select(*[c for c in raw.columns if c != content], F.posexplode(rows).alias("pos", "r"))
    title, address = _filled(F.col("r.title"), F.col("r.headline")), _filled(F.col("r.url"), F.col("r.link"))
    summary = _filled(F.col("r.summary"), F.col("r.description"), F.col("r.body"))
    valid = flat.where(title.isNotNull() & address.isNotNull())
    keys = [c for c in raw.columns if c != content]
    return keep_newest(valid, keys, [F.col("pos")], most).select(
        *keys,
        "pos",
        F.trim(title).alias("title"),
        F.trim(F.when(address.startswith("/"), F.concat(F.lit(site), address)).otherwise(address)).alias("url"),
        dates.parse_formats(_filled(F.col("r.date"), F.col("r.publishedAt"), F.col("r.created")), now).alias("published"),
        F.trim(truncated(summary, 500)).alias("summary"),
    )


def listed_reports(raw: DataFrame, content: str, site: str, now: Column) -> DataFrame:
    """A JSON list of reports: those with a title and a URL, made absolute; a date
    that is missing or bad is ``now``."""
    item = "struct<title:string,url:string,date:string,authors:string,author:string>"
    flat = raw.select(*[c for c in raw.columns if c != content], F.posexplode(F.from_json(content, f"array<{item}>")).alias("pos", "r"))
    valid = flat.where(_filled(F.col("r.title")).isNotNull() & _filled(F.col("r.url")).isNotNull())
    absolute = F.when(url.is_web_url(F.col("r.url")), F.col("r.url")).otherwise(F.concat(F.lit(site + "/"), F.ltrim(F.col("r.url"), F.lit("/"))))
    return valid.select(
        *[c for c in raw.columns if c != content],
        "pos",
        F.trim("r.title").alias("title"),
        absolute.alias("url"),
        F.coalesce(F.try_to_timestamp("r.date", F.lit("yyyy-MM-dd")), now).alias("published"),
        F.coalesce("r.authors", "r.author").alias("author"),
        F.array(*map(F.lit, REPORT_TAGS)).alias("tags"),
    )


def papers(raw: DataFrame, key: str, content: str) -> DataFrame:
    """Papers with nested authors, references and citations; null lists are empty."""
    p = raw.select(key, F.from_json(content, _PAPER).alias("p"))
    cited = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: F.struct(F.coalesce(x["title"], F.lit("")).alias("title"), x["externalIds"]["ArXiv"].alias("arxiv_id"), x["paperId"].alias("paper_id")))
    authors = F.transform(F.coalesce("p.authors", F.array()), lambda a: F.struct(F.coalesce(a["name"], F.lit("Unknown")).alias("name"), a["authorId"].alias("author_id")))
    return p.select(
        key, F.coalesce("p.title", F.lit("")).alias("title"), authors.alias("authors"), cited(F.col("p.references")).alias("references"), cited(F.col("p.citations")).alias("citations"),
        F.col("p.abstract").alias("abstract"), F.col("p.paperId").alias("paper_id"), F.col("p.publicationDate").alias("published"),
    )


def cached(cache: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Entries (key, value, created_at) that are not older than their time to live;
    of a repeated key the newest is the entry."""
    newest = cache.groupBy("key").agg(F.max_by("value", "created_at").alias("value"), F.max("created_at").alias("created_at"))
    return newest.where(F.unix_micros(now) - F.unix_micros("created_at") <= ttl_seconds * 1_000_000)


def resolved_papers(wanted: DataFrame, cache: DataFrame, batch: DataFrame, single: DataFrame) -> DataFrame:
    """wanted (pos, id) with the value and origin (cache, batch or single) of each,
    in three steps: what the cache (key, value) has; of what it lacks, numbered
    in order, the batch answer (number, value) at that place; where that is null
    or missing, the single answer (id, value).  What nothing has is left out."""
    from finloom.operators.reports import numbered

    first = wanted.join(cache.select(F.col("key").alias("id"), "value"), "id", "left")
    asked = numbered(first.where(F.col("value").isNull()).select("pos", "id"), ["pos"])
    of_batch = asked.join(batch.select("number", F.col("value").alias("of_batch")), "number", "left")
    both = of_batch.join(single.select("id", F.col("value").alias("of_single")), "id", "left")
    rest = both.select("pos", "id", F.coalesce("of_batch", "of_single").alias("value"), F.when(F.col("of_batch").isNotNull(), "batch").otherwise("single").alias("origin"))
    return first.where(F.col("value").isNotNull()).select("pos", "id", "value", F.lit("cache").alias("origin")).unionByName(rest.where(F.col("value").isNotNull()))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """An exported sheet: the header names the columns, all values are text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)
