"""Dedup, difference and upsert.

Order decides who wins, so every operator takes the columns that order rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key by ``order``; nulls are a key of their own.

    An aggregation that combines before its shuffle finds the winners' order,
    so a hot key sends one row a task; the whole rows of a key never meet.
    """
    packed = F.struct(*df.columns)
    best = F.min_by(packed, F.struct(*order)).alias("row")
    return df.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(best).select("row.*")


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order``."""
    best = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("row")
    return df.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(best).select("row.*")


def new_rows(fetched: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Fetched rows whose key doesn't exist yet; repeats among them stay."""
    return fetched.join(existing.select(key).distinct(), key, "left_anti")


def processed(hashes: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Rows with whether their key has been completed: state (key, status)."""
    done = state.where("status = 'completed'").select(key).distinct().withColumn("done", F.lit(True))
    return hashes.join(done, key, "left").withColumn("done", F.coalesce("done", F.lit(False)))


def unseen(fetched: DataFrame, history: DataFrame, key: str, seen_at: str, cutoff: str, null_is_seen: bool) -> DataFrame:
    """Fetched rows not seen since ``cutoff``.  An entry without a time counts
    as seen or not, by ``null_is_seen``."""
    since = F.coalesce(F.col(seen_at) >= F.to_timestamp(F.lit(cutoff)), F.lit(null_is_seen))
    return new_rows(fetched, history.where(since), key)


def drop_consecutive(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Drop rows whose value equals that of the row before in their group."""
    before = F.lag(value).over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_before", before).where(~F.col(value).eqNullSafe(F.col("_before")) | F.col("_before").isNull()).drop("_before")


def upsert(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``changes`` replace those of ``target`` with their key."""
    return target.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes)


def upsert_keep(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """As ``upsert`` with one row a key on both sides; a null in ``changes`` keeps the old value."""
    others = [c for c in target.columns if c != key]
    return target.alias("t").join(changes.alias("c"), key, "full_outer").select(
        key, *[F.coalesce(F.col(f"c.{x}"), F.col(f"t.{x}")).alias(x) for x in others]
    )


def insert_absent(target: DataFrame, new: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Target and the first new row of every key it lacks, with ``added``."""
    fresh = first_wins(new_rows(new, target, key), [key], order)
    return target.withColumn("added", F.lit(False)).unionByName(fresh.withColumn("added", F.lit(True)))


def sticky_state(log: DataFrame, key: str, success: Column, at: str) -> DataFrame:
    """State by key of a log of attempts: success once is success for good;
    retries counts failures; updated is the last attempt."""
    return log.groupBy(key).agg(
        F.max(success.cast("int")).cast("int").alias("success"),
        F.count_if(~success).alias("retries"),
        F.max(at).alias("updated"),
    )


def keep_newest(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of every group; Spark limits groups before its shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def batches(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Rows with the number of their batch of ``size`` in the given order.

    Range partitions are numbered inside and shifted by the sizes of those
    before, so no task sees all rows.
    """
    from finloom.storage import materialise

    sorted_rows = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id() % (1 << 33)).alias("_at")),
        "batches",
    )
    sizes = sorted_rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.floor((F.col("_at") + F.col("_before")) / size).cast("long")
    return sorted_rows.join(F.broadcast(shifts), "_part").withColumn("batch", number).drop("_part", "_at", "_before")
