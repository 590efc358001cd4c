"""Incremental operators on streams of files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import shared_dir


def stream_of(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """Files at or under ``path`` as a stream, a few a batch.

    A path that names one file can't be watched; as a pattern it can.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path.rstrip('/')}*")


def new_items(stream: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Arriving rows whose key isn't in the static table; repeats stay."""
    known = existing.select(F.col(key).alias("_key")).distinct()
    return stream.join(known, F.col(key) == F.col("_key"), "left_outer").where(F.col("_key").isNull()).drop("_key")


def first_seen(stream: DataFrame, key: str, at: str, ttl: str) -> DataFrame:
    """The first row of a key within ``ttl``; state older than that is dropped."""
    return stream.withWatermark(at, ttl).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, at: str, by: str, size: str, late: str) -> DataFrame:
    """Counts of windows; rows later than ``late`` don't count."""
    counts = stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), by).agg(F.count("*").alias("n"))
    return counts.select("w.start", "w.end", by, "n")


def quota(stream: DataFrame, group: str, order: str, units: str, budget: float) -> DataFrame:
    """group, used, accepted and rejected after every batch: requests that would
    pass the budget are rejected and not added.  Rows of a batch are taken in
    the order of ``order``; the state is three numbers a group."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        used, accepted, rejected = state.get if state.exists else (0.0, 0, 0)
        # Only the two columns that decide, of one trigger's rows of the group.
        rows = pd.concat([b[[order, units]] for b in batches]).sort_values(order)
        for u in rows[units]:
            if used + u <= budget:
                used, accepted = used + float(u), accepted + 1
            else:
                rejected += 1
        state.update((used, accepted, rejected))
        yield pd.DataFrame({group: [key[0]], "used": [used], "accepted": [accepted], "rejected": [rejected]})

    kind = dict(stream.dtypes)[group]
    return stream.groupBy(group).applyInPandasWithState(
        step, f"{group} {kind}, used double, accepted long, rejected long", "used double, accepted long, rejected long", "update", GroupStateTimeout.NoTimeout
    )


def run_once(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there, and read the written rows."""
    spark = df.sparkSession
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-checkpoint")
    writer.outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query("""
SELECT d.doc_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 3 = 0 AND e.text = d.text)""")
def stream_diff_new_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's version of diff_new_items."""
    docs = table(spark, sf_dir, "documents")
    stream = stream_of(spark, f"{sf_dir}/documents.parquet", docs.schema).select("doc_id", F.sha2("text", 256).alias("digest"))
    known = docs.where("doc_id % 3 = 0").select(F.sha2("text", 256).alias("digest"))
    return run_once(new_items(stream, known, "digest").select("doc_id"), shared_dir(spark, "stream-diff"))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'error'")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by their first error; the time to live exceeds the table's month."""
    events = table(spark, sf_dir, "events")
    stream = stream_of(spark, f"{sf_dir}/events.parquet", events.schema).where("event_type = 'error'")
    stream = stream.select("user_id", F.col("ts").cast("timestamp").alias("at"))
    return run_once(first_seen(stream, "user_id", "at", "60 days").select("user_id"), shared_dir(spark, "stream-first"))
