"""Feeds, sitemaps, robots files, captions, markdown, pages and session logs.

Raw documents come as rows with their content; every reader keeps the other
columns' keys it is given and skips malformed entries.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_RSS = (
    "channel struct<item:array<struct<title:string,link:string,pubDate:string,description:string,author:string,guid:string>>>"
)
_SITEMAP = "url array<struct<loc:string,lastmod:string,changefreq:string,priority:string>>"
_INDEX = "sitemap array<struct<loc:string>>"
# Keys of robots files that address crawlers of language models.
AI_DIRECTIVES = ("ai-training", "ai-generated", "noai", "noimageai")


def parse_time(text: Column) -> Column:
    """ISO 8601 or RFC 2822 as a timestamp; null if neither."""
    mail = F.regexp_replace(F.regexp_replace(text, "^[A-Za-z]{3}, *", ""), "(GMT|UTC|Z)$", "+0000")
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")))


def feed_items(feeds: DataFrame, key: str, content: str) -> DataFrame:
    """key, pos, title, link, published (timestamp or null) and summary of every
    item of RSS documents; items without a link are left out."""
    parsed = feeds.select(key, F.from_xml(content, _RSS, {"mode": "PERMISSIVE"}).alias("x"))
    items = parsed.select(key, F.posexplode("x.channel.item").alias("pos", "i"))
    return items.select(
        key, "pos", "i.title", "i.link", parse_time(F.col("i.pubDate")).alias("published"), F.col("i.description").alias("summary")
    ).where(F.col("link").isNotNull())


def sitemap_entries(maps: DataFrame, key: str, content: str) -> DataFrame:
    """key, loc, lastmod, changefreq and priority (null if not a number)."""
    parsed = maps.select(key, F.from_xml(content, _SITEMAP, {"mode": "PERMISSIVE"}).alias("x"))
    rows = parsed.select(key, F.inline("x.url"))
    return rows.withColumn("priority", F.expr("try_cast(priority AS double)")).where(F.col("loc").isNotNull())


def sitemap_tree(maps: DataFrame, root: str, depth: int = 3) -> DataFrame:
    """url of all sitemaps (url, content) that the index ``root`` reaches in at most ``depth`` steps."""
    children = maps.select("url", F.explode(F.transform(F.from_xml("content", _INDEX).getField("sitemap"), lambda s: s["loc"])).alias("child"))
    found = maps.where(F.col("url") == root).select("url").distinct()
    frontier = found
    for _ in range(depth):
        frontier = children.join(frontier, "url").select(F.col("child").alias("url")).distinct().join(found, "url", "left_anti")
        found = found.unionByName(frontier)
    return found.join(maps.select("url").distinct(), "url", "left_semi")


def robots_directives(text: Column, keys: tuple[str, ...] = AI_DIRECTIVES) -> Column:
    """Map of the ``key: value`` lines with a listed key; the last value of a key wins."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.lower(F.trim(F.substring_index(x, ":", 1))).isin(*keys) & F.contains(x, F.lit(":")))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    last = F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda p: p["k"] == n), -1)["v"])
    return F.map_from_arrays(names, last)


def caption_cues(captions: DataFrame, key: str, content: str) -> DataFrame:
    """key, pos, start, end (seconds) and text of WebVTT cues without tags; a cue
    equal to the one before it is dropped."""
    blocks = captions.select(key, F.posexplode(F.split(content, r"\n\s*\n")).alias("pos", "block"))
    stamp = r"(?:(\d+):)?(\d\d):(\d\d\.\d+) --> (?:(\d+):)?(\d\d):(\d\d\.\d+)"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract("block", stamp, i), F.lit("")).cast("double"), F.lit(0.0))
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("block", r"(?s)-->[^\n]*\n(.*)", 1), "<[^>]*>", ""), r"\s+", " "))
    cues = blocks.where(F.col("block").rlike(stamp)).select(
        key, "pos", (part(1) * 3600 + part(2) * 60 + part(3)).alias("start"), (part(4) * 3600 + part(5) * 60 + part(6)).alias("end"), text.alias("text")
    )
    from finloom.operators.dedup import drop_consecutive

    return drop_consecutive(cues.where("text <> ''"), [key], ["pos"], "text")


def frontmatter(text: Column) -> Column:
    """Map of the ``key: value`` lines between the leading ``---`` lines; null without them."""
    body = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)
    pairs = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:"))
    names = F.array_distinct(F.transform(pairs, lambda p: F.substring_index(p, ":", 1)))
    value = lambda n: F.trim(F.regexp_replace(F.element_at(F.filter(pairs, lambda p: F.substring_index(p, ":", 1) == n), -1), "^[^:]*:", ""))
    return F.when(text.rlike(r"(?s)\A---\n.*?\n---(?:\n|\z)"), F.map_from_arrays(names, F.transform(names, lambda n: F.regexp_replace(value(n), "^[\"']|[\"']$", ""))))


def sections(text: Column, heading: str = r"#{1,6}\s") -> Column:
    """Sections of a text: each starts at a line that begins with ``heading``;
    what stands before the first is a section, if not blank."""
    cut = F.split(text, rf"(?m)(?=^{heading})")
    return F.filter(cut, lambda s: F.trim(s) != "")


def section_heading(section: Column, heading: str = r"#{1,6}\s") -> Column:
    return F.nullif(F.trim(F.regexp_extract(section, rf"\A{heading}\s*([^\n]*)", 1)), F.lit(""))


def pdf_links(html: Column) -> Column:
    """Distinct targets of links to PDF files, in order."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*\bhref=["']([^"']+)["']"""), F.lit(1))
    return F.array_distinct(F.filter(links, lambda u: F.lower(F.regexp_replace(u, "[?#].*$", "")).endswith(".pdf")))


class _ArticleText(HTMLParser):
    """Text of the article elements, or of everything if there is none."""

    SKIPPED = ("script", "style", "noscript")

    def __init__(self):
        super().__init__()
        self.all, self.inside, self.depth, self.skip = [], [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in self.SKIPPED
        self.depth += tag == "article"

    def handle_endtag(self, tag):
        self.skip -= tag in self.SKIPPED and self.skip > 0
        self.depth -= tag == "article" and self.depth > 0

    def handle_data(self, data):
        if not self.skip and (words := " ".join(data.split())):
            self.all.append(words)
            if self.depth:
                self.inside.append(words)


def _text_of(html: str | None) -> str:
    parser = _ArticleText()
    parser.feed(html or "")
    return "\n".join(parser.inside or parser.all)


@F.pandas_udf(StringType())
def article_text(html: pd.Series) -> pd.Series:
    """Text of a page's article, a line a text node; null counts as empty."""
    return html.map(_text_of)


def sessions(turns: DataFrame, session: str, order: str, role: str, text: str, first_texts: int = 5) -> DataFrame:
    """One row a session: its first and last turn, counts of roles, and the first
    texts of the user.  Only numbered starts of texts are gathered."""
    user = F.col(role) == "user"
    base = turns.groupBy(session).agg(
        F.min(order).alias("first_turn"), F.max(order).alias("last_turn"), F.count_if(user).alias("n_user"), F.count_if(~user).alias("n_other")
    )
    from finloom.operators.dedup import keep_newest

    early = keep_newest(turns.where(user), [session], [F.col(order), F.col(text)], first_texts)
    said = early.groupBy(session).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("s"))
    joined = base.join(said, session, "left")
    return joined.select(session, "first_turn", "last_turn", "n_user", "n_other", F.coalesce(F.transform("s", lambda x: x["t"]), F.array().cast("array<string>")).alias("first_texts"))


def read_json_rows(spark: SparkSession, path: str, schema: StructType | str, rows: str) -> DataFrame:
    """Rows of the array ``rows`` of JSON documents under ``path``, with the file
    they came from; malformed documents give no rows."""
    docs = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return docs.select(F.col("_metadata.file_path").alias("file"), F.posexplode(rows).alias("pos", "row")).select("file", "pos", "row.*")
