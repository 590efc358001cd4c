"""Folders of files as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators.dedup import first_wins
from finloom.sources.documents import frontmatter, sections


def hashed_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """file and sha256 of the files under ``path``; contents never leave their task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), F.sha2("content", 256).alias("sha256"))


def markdown_sources(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """file, url, title and sections of markdown files with a ``url`` in their frontmatter."""
    read = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path, wholetext=True)
    front = read.select(F.col("_metadata.file_path").alias("file"), "value", frontmatter(F.col("value")).alias("front"))
    body = F.regexp_replace("value", r"(?s)\A---\n.*?\n---(?:\n|\z)", "")
    return front.select("file", F.try_element_at("front", F.lit("url")).alias("url"), F.try_element_at("front", F.lit("title")).alias("title"), sections(body).alias("sections")).where(
        F.coalesce(F.col("url") != "", F.lit(False))
    )


def raw_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles of JSON documents ``{news: [...]}``: rows without a URL dropped,
    the first of every URL by file and position."""
    schema = "news array<struct<title:string,url:string,source:string,published:string,category:string,summary:string,content:string>>"
    docs = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    flat = docs.select(F.col("_metadata.file_path").alias("file"), F.posexplode("news").alias("pos", "n")).select("file", "pos", "n.*")
    return first_wins(flat.where(F.coalesce(F.col("url") != "", F.lit(False))), ["url"], ["file", "pos"])


def symbols(config: DataFrame, column: str) -> DataFrame:
    """Distinct values of every ``symbol`` field, however deeply a JSON document nests it."""
    flat = config.select(F.expr(f"regexp_extract_all({column}, '\"symbol\"\\\\s*:\\\\s*\"([^\"]+)\"', 1)").alias("found"))
    return flat.select(F.explode("found").alias("symbol")).distinct()
