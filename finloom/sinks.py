"""Sinks: appends, upserts and documents on plain files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.operators.dedup import first_wins, new_rows, upsert


def append_new(new: DataFrame, path: str, key: str, order: Sequence[str]) -> DataFrame:
    """Append the rows whose key the table at ``path`` lacks, the first of each,
    and return the table.  The first write makes it."""
    spark = new.sparkSession
    from finloom.storage import materialise

    fresh = first_wins(new, [key], order)
    if _exists(spark, path):
        fresh = new_rows(fresh, spark.read.schema(new.schema).parquet(path), key)
    materialise(fresh.select(*new.columns), "append-new").write.mode("append").parquet(path)
    return spark.read.schema(new.schema).parquet(path)


def replace_index(changes: DataFrame, path: str, to: str, key: str) -> DataFrame:
    """The index at ``path`` with ``changes`` by key, written to ``to``: the old
    version stays until the new one is complete."""
    spark = changes.sparkSession
    old = spark.read.schema(changes.schema).parquet(path) if _exists(spark, path) else changes.limit(0)
    upsert(old, changes, key).write.parquet(to)
    return spark.read.schema(changes.schema).parquet(to)


def write_documents(nodes: DataFrame, edges: DataFrame, path: str, command: str) -> None:
    """Nodes by label and edges by type as JSON lines under the command's folder."""
    nodes.write.mode("overwrite").partitionBy("label").json(f"{path}/command={command}/nodes")
    edges.write.mode("overwrite").partitionBy("type").json(f"{path}/command={command}/edges")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def article_file(articles: DataFrame) -> DataFrame:
    """One row of JSON a day: its number of articles, its sources, and the table's
    rows as lines beside it stay relational."""
    by_day = articles.groupBy(F.to_date("published").alias("day"))
    return by_day.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("source")).alias("sources")).select(
        "day", F.to_json(F.struct("n", "sources")).alias("meta")
    )


def expired(partitions: DataFrame, day: str, today: str, days: int) -> DataFrame:
    """Partitions named by a date over ``days`` before ``today``; other names never expire."""
    at = F.expr(f"try_cast({day} AS date)")
    return partitions.where(F.coalesce(at < F.date_sub(F.to_date(F.lit(today)), days), F.lit(False)))


def replace_partition(df: DataFrame, path: str, by: str) -> None:
    """Write rows in folders by a column: the folders that they fall into are
    replaced whole when the job commits, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append_run(df: DataFrame, path: str, day: str) -> None:
    """Append the rows of a run under its day."""
    df.withColumn("dt", F.lit(day)).write.mode("append").partitionBy("dt").parquet(path)


def append_lines(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines."""
    df.write.mode("append").json(path)


def json_documents(df: DataFrame, key: str) -> DataFrame:
    """Every row as one JSON document (nulls left out) beside its key."""
    return df.select(key, F.to_json(F.struct(*df.columns)).alias("document"))


def converted_news(articles: DataFrame, start: str, end: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Articles (published: date, category) of a period with their number from 1 in
    the given order, and the count of every category; undated ones are left out."""
    from finloom.operators.reports import numbered

    kept = articles.where(F.col("published").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return numbered(kept, order), kept.groupBy("category").agg(F.count("*").alias("n"))


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
