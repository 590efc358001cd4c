"""Lists of articles and reports that pages show, as rows.

Built on ``markup.select_rows``: one pass over a page finds its rows and their
fields; what counts as a row of a list is decided by column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from finloom.functions import dates
from finloom.functions import url as urls
from finloom.operators.dedup import keep_newest
from finloom.sources.markup import Field, select_rows

# What marks the rows of three publishers' pages and their fields.
NEWS_TABLE_ROWS = "table[class*='s_news_list'] tr"
NEWS_TABLE_FIELDS = {
    "title": Field("td:nth-of-type(3) > a", "nodes", every=True),
    "href": Field("td:nth-of-type(3) > a[href]", "@href"),
    "at": Field("td[class='news_time'] > time[datetime]", "@datetime"),
    "kind": Field("td:nth-of-type(2) > div[class*='newslist_ctg']", "nodes", every=True),
}
LINK_PATTERN = r"^(?:/news/[0-9]+|https?://[^?#]*minkabu\.jp/news/[0-9]+(?:[?#].*)?)$"
CARDS = {
    "markets": ("[data-testid='HeroCard'], [data-testid='BasicCard']", ("[data-testid='Title'] a[href]", ":scope[href]")),
    "business": ("[data-testid='MediaStoryCard']", ("h3[data-testid='Heading'] a[href]", "a[data-testid='Heading'][href]")),
}


def _absolute(href: str | None, base: str | None) -> str | None:
    try:
        return None if href is None else urljoin(base or "", href)
    except ValueError:
        return None


@F.pandas_udf(StringType())
def absolute(href: pd.Series, base: pd.Series) -> pd.Series:
    """A link of the page at ``base``; null if it or the page's address is malformed."""
    return pd.Series([_absolute(h, b) for h, b in zip(href, base)], dtype=object)


def _first(name: str) -> Column:
    return F.get(F.col(name), 0)


def _filled(value: Column) -> Column:
    """Text without white space around it; null if nothing is left."""
    return F.nullif(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""), F.lit(""))


def _kept(rows: DataFrame, keys: list[str], most: int | None) -> DataFrame:
    """The first row of every URL of a page and of these the first ``most``."""
    unique = keep_newest(rows, [*keys, "url"], [F.col("row")], 1)
    return unique if most is None else keep_newest(unique, keys, [F.col("row")], most)


def article_rows(pages: DataFrame, key: str, html: str, base: str, rows: str, title: str, date: str | None = None, most: int | None = None) -> DataFrame:
    """key, row, title, url and date (text or null) of the elements ``rows`` with a title and a link.

    Selectors are CSS; ``title`` and ``date`` are searched in the row.  The link
    is the title's own, else that of the first anchor in it, made absolute
    against the column ``base``.  ``most``: only the first rows of a page with
    different URLs; without it all rows.
    """
    fields = {"title": Field(title), "own": Field(":scope", "@href", within="title"), "link": Field("a", "@href", within="title")}
    fields |= {"date": Field(date)} if date else {}
    found = select_rows(pages, key, html, rows, fields, (base,))
    href = F.coalesce(F.nullif(_first("own"), F.lit("")), F.nullif(_first("link"), F.lit("")))
    shown = found.select(
        key, "row", _filled(_first("title")).alias("title"), absolute(href, F.col(base)).alias("url"), (_filled(_first("date")) if date else F.lit(None).cast("string")).alias("date")
    ).where("title IS NOT NULL AND url IS NOT NULL")
    return shown if most is None else _kept(shown, [key], most)


def news_table_rows(pages: DataFrame, key: str, html: str, site: str, now: Column) -> DataFrame:
    """Rows of news tables (time, kind, linked title) as articles: key, row, title,
    url, published, kind.  Rows without a title are left out; a row without a
    link has the address ``site``, one without a readable time ``now``."""
    found = select_rows(pages, key, html, NEWS_TABLE_ROWS, NEWS_TABLE_FIELDS)
    href = _filled(_first("href"))
    return found.select(
        key,
        "row",
        _filled(_first("title")).alias("title"),
        F.when(href.isNull(), F.lit(site)).otherwise(absolute(href, F.lit(site))).alias("url"),
        F.coalesce(dates.parse_local(F.trim(_first("at")), "UTC"), now).alias("published"),
        F.trim(_first("kind")).alias("kind"),
    ).where("title IS NOT NULL")


def link_items(pages: DataFrame, key: str, html: str, site: str, now: Column, most: int, pattern: str = LINK_PATTERN) -> DataFrame:
    """List items that link to an article (``pattern`` of its address), or where a page
    has none the links themselves: key, row, title, url, published.

    The title is that of the headings in the link, else the texts directly in it
    and of its paragraphs; without one a row is left out.  The first of every
    URL, ``most`` a page at most.
    """
    fields = {
        "href": Field("a", "@href", matching=pattern),
        "heading": Field("h1, h2, h3", within="href", outside="time", every=True),
        "direct": Field(":scope, p, p *", "nodes", within="href", outside="time", every=True),
        "at": Field("time", "@datetime"),
        "shown_at": Field("time"),
        "item": Field("li:scope", "@class"),
    }
    found = select_rows(pages, key, html, "li, a", fields).where(F.size("href") > 0).withColumn("kind", F.when(F.size("item") > 0, 0).otherwise(1))
    # Whether a page has items at all is known before rows without titles go.
    both = found.withColumn("first", F.min("kind").over(Window.partitionBy(key)))
    heading = _filled(F.array_join("heading", ""))
    direct = F.array_join(F.filter(F.transform("direct", lambda t: _filled(t)), lambda t: t.isNotNull()), " ")
    at = F.coalesce(F.nullif(F.trim(_first("at")), F.lit("")), F.trim(_first("shown_at")))
    shown = both.where("kind = first").select(
        key, "row", F.coalesce(heading, _filled(direct)).alias("title"), absolute(F.trim(_first("href")), F.lit(site)).alias("url"), F.coalesce(dates.parse_local(at), now).alias("published")
    )
    return _kept(shown.where("title IS NOT NULL"), [key], most)


def cards(pages: DataFrame, key: str, html: str, section: str, site: str, now: Column) -> DataFrame:
    """Cards of a section's page (``CARDS``) as articles: key, row, title, url, published,
    category.  Cards without a title or a link are left out."""
    rows, (first, second) = CARDS[section]
    fields = {"title": Field("[data-testid='Heading']", every=True), "first": Field(first, "@href"), "second": Field(second, "@href"), "at": Field("time[datetime]", "@datetime")}
    found = select_rows(pages, key, html, rows, fields)
    # A heading in a heading is part of its text.
    href = F.coalesce(_filled(_first("first")), _filled(_first("second")))
    return found.select(
        key,
        "row",
        _filled(_first("title")).alias("title"),
        absolute(href, F.lit(site)).alias("url"),
        F.coalesce(dates.parse_local(F.trim(_first("at")), "UTC"), now).alias("published"),
        F.lit(section).alias("category"),
    ).where("title IS NOT NULL AND url IS NOT NULL")


def report_items(pages: DataFrame, key: str, html: str, base: str, items: str, tags: Sequence[str], now: Column, pdf: str | None = None) -> DataFrame:
    """Elements ``items`` with a link and a text of their own as reports: key, row, url, title,
    published, pdf_url, tags.  The PDF is the first of the links ``pdf`` in the
    element that is one, else the report itself if it is one."""
    fields = {"href": Field(":scope", "@href"), "title": Field(":scope", "nodes")} | ({"pdf": Field(pdf, "@href", every=True)} if pdf else {})
    found = select_rows(pages, key, html, items, fields, (base,))
    listed = found.select(key, "row", base, F.nullif(_first("title"), F.lit("")).alias("title"), F.nullif(_first("href"), F.lit("")).alias("href"), (F.col("pdf") if pdf else F.lit(None).cast("array<string>")).alias("pdf"))
    valid = listed.where("title IS NOT NULL AND href IS NOT NULL").withColumn("url", absolute("href", base))
    linked = F.filter("pdf", lambda u: (u != "") & urls.is_pdf(u))
    first = F.get(linked, 0)
    own = F.when(urls.is_pdf(F.col("url")), F.col("url"))
    return valid.select(
        key, "row", "url", F.trim("title").alias("title"), now.alias("published"), F.coalesce(absolute(first, F.col(base)), own).alias("pdf_url"), F.array(*map(F.lit, tags)).cast("array<string>").alias("tags")
    )


def links(pages: DataFrame, key: str, html: str, base: str, css: str) -> DataFrame:
    """key, row and absolute url of the elements ``css`` with a link, repeats included."""
    found = select_rows(pages, key, html, css, {"href": Field(":scope", "@href")}, (base,))
    return found.where(_first("href") != "").select(key, "row", absolute(_first("href"), F.col(base)).alias("url"))
