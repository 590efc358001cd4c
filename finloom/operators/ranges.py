"""Joins on ranges of an ordered column: intervals that overlap, the last row before."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.storage import materialise, spread

#: Bins that intervals are cut into at most.
BINS = 1000
#: Bits of time that a level of ``counts_in_intervals`` takes away.
LEVEL_BITS = 3


def _bin_of(bounds: np.ndarray):
    @F.pandas_udf("int")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, x.to_numpy(), side="right").astype(np.int32))

    return place


def interval_join(left: DataFrame, right: DataFrame, start: str, end: str, by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """Pairs of rows whose half-open intervals [start, end) overlap and whose columns
    ``by`` are equal; left columns as l_..., right ones as r_....

    start and end are numbers (or cast to bigint as such).  Time is cut into bins
    at quantiles of all starts, a row is in every bin it touches, and rows meet
    in bins.  A pair that meets in several is made in one alone: the bin of the
    later of both starts.  Rows with a null bound, a null in ``by`` or an empty
    interval overlap nothing.  Bins are keys of an ordinary join, so a bin with
    very many equal starts is split by adaptive execution.
    """

    def prepared(df: DataFrame, side: str) -> DataFrame:
        named = df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns), F.col(start).cast("bigint").alias(f"_{side}a"), F.col(end).cast("bigint").alias(f"_{side}b"))
        known = F.col(f"_{side}a") < F.col(f"_{side}b")
        for c in by:
            known &= F.col(f"{side}_{c}").isNotNull()
        return named.where(known)

    a, b = prepared(left, "l"), prepared(right, "r")
    starts = a.select(F.col("_la").alias("x")).unionAll(b.select(F.col("_ra").alias("x")))
    cuts = starts.agg(F.percentile_approx("x", [i / bins for i in range(1, bins)], 10 * bins)).first()[0] if bins > 1 else []
    place = _bin_of(np.unique(np.array(cuts or [], np.int64)))

    def binned(df: DataFrame, side: str) -> DataFrame:
        own = df.withColumn(f"_{side}bin", place(F.col(f"_{side}a"))).withColumn("_last", place(F.col(f"_{side}b") - 1))
        return own.withColumn("_bin", F.explode(F.sequence(F.col(f"_{side}bin"), F.col("_last")))).drop("_last")

    x, y = binned(a, "l").alias("x"), binned(b, "r").alias("y")
    meet = F.col("x._bin") == F.col("y._bin")
    for c in by:
        meet &= F.col(f"l_{c}") == F.col(f"r_{c}")
    overlap = (F.col("_la") < F.col("_rb")) & (F.col("_ra") < F.col("_lb")) & (F.col("x._bin") == F.greatest("_lbin", "_rbin"))
    return x.join(y, meet & overlap).select(*(f"l_{c}" for c in left.columns), *(f"r_{c}" for c in right.columns))


def counts_in_intervals(intervals: DataFrame, points: DataFrame, start: str, end: str, at: str, item: str) -> DataFrame:
    """Every interval [start, end) that holds a point: its columns, the number of its
    points (n_points), their smallest ``item`` (first_item) and their largest
    time (last_at), without a pair of an interval and a point.

    start, end and at are numbers (or cast to bigint as such).  Time is cut into
    blocks of 1, 8, 64, ... units; points are summed up by block at each level,
    and an interval is the sum of the largest blocks that lie in it, 14 a level at
    most.  So rows grow with points and intervals, times the levels that the
    longest interval needs, however many points an interval holds.  Equal
    intervals are summed up once.  Rows with a null bound or time, or an empty
    interval, are left out.
    """
    bounds = [F.col(start).cast("bigint").alias("_a"), F.col(end).cast("bigint").alias("_b")]
    spans = intervals.select(*bounds).where("_a < _b").distinct()
    longest = spans.agg(F.max(F.col("_b") - F.col("_a"))).first()[0] or 1
    # No block is longer than the longest interval.
    top = (int(longest).bit_length() - 1) // LEVEL_BITS

    known = points.select(F.col(at).cast("bigint").alias("_at"), F.col(item).alias("_item")).where("_at IS NOT NULL")
    moments = known.groupBy("_at").agg(F.count("*").alias("n"), F.min("_item").alias("low"))
    of_time = F.array(*[F.struct(F.lit(i).alias("level"), F.shiftright("_at", LEVEL_BITS * i).alias("place")) for i in range(top + 1)])
    blocks = moments.select("n", "low", "_at", F.inline(of_time)).groupBy("level", "place").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("_at").alias("last"))

    # At each level what sticks out on both sides of whole blocks of the next one; [lo, hi) is in units of the level.
    cover = []
    a, b = F.col("_a"), F.col("_b")
    places = lambda x, y: F.when(x < y, F.sequence(x, y - 1)).otherwise(F.array().cast("array<bigint>"))
    for i in range(top + 1):
        # Whole blocks of this level and of the next: rounded up at the start, down at the end.
        lo, hi = (-F.shiftright(-a, LEVEL_BITS * i)), F.shiftright(b, LEVEL_BITS * i)
        next_lo, next_hi = -F.shiftright(-a, LEVEL_BITS * (i + 1)), F.shiftright(b, LEVEL_BITS * (i + 1))
        inner = (next_lo < next_hi) if i < top else F.lit(False)
        sides = F.concat(places(lo, next_lo * 2**LEVEL_BITS), places(next_hi * 2**LEVEL_BITS, hi))
        found = F.when(inner, sides).otherwise(places(lo, hi))
        cover.append(F.struct(F.lit(i).alias("level"), found.alias("places")))
    parts = spans.select("_a", "_b", F.inline(F.array(*cover))).select("_a", "_b", "level", F.explode("places").alias("place"))
    met = parts.join(blocks, ["level", "place"]).groupBy("_a", "_b").agg(F.sum("n").alias("n_points"), F.min("low").alias("first_item"), F.max("last").alias("last_at"))
    return intervals.join(spread(met), (bounds[0] == F.col("_a")) & (bounds[1] == F.col("_b"))).drop("_a", "_b")


def as_of_join(left: DataFrame, right: DataFrame, at: str, by: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Every left row with the last right row of its key at or before its time: left
    columns as they are, right ones (but ``by``) as r_..., null without one.

    A sort-merge over the union of both: rows are sorted by ranges of (by, at), so a
    key with most rows is cut over tasks; what is the last right row of a key
    before a range comes from a table of one row a range and key.  Right rows of
    equal times are told apart by ``order``, the last counts.  A null time
    matches nothing; null keys are equal.
    """
    values = [c for c in right.columns if c not in by]
    row = F.struct(*(F.col(c).alias(f"r_{c}") for c in values))
    kind = right.select(row.alias("r")).schema["r"].dataType
    l_kind = left.select(F.struct(*left.columns).alias("l")).schema["l"].dataType
    rank = F.struct(*order) if order else F.struct(F.lit(0))
    rank_type = right.select(rank.alias("o")).schema["o"].dataType
    keys = [f"_k{i}" for i in range(len(by))]
    key = [F.col(c).alias(k) for c, k in zip(by, keys)]
    rights = right.where(F.col(at).isNotNull()).select(*key, F.col(at).alias("_at"), F.lit(0).alias("_side"), rank.alias("_o"), F.lit(None).cast(l_kind).alias("_l"), row.alias("_r"))
    lefts = left.where(F.col(at).isNotNull()).select(*key, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(rank_type).alias("_o"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(kind).alias("_r"))
    by_time = [*keys, "_at", "_side", "_o"]
    number = F.monotonically_increasing_id()
    ranges = rights.unionByName(lefts).repartitionByRange(*by_time).sortWithinPartitions(*by_time)
    both = materialise(ranges.select("*", number.alias("_n")).withColumn("_part", F.shiftright("_n", 33)), "as-of")
    inside = Window.partitionBy("_part", *keys).orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_found", F.last("_r", ignorenulls=True).over(inside)).where("_side = 1")
    parts = both.groupBy("_part", *keys).agg(F.max_by("_r", F.when(F.col("_side") == 0, F.col("_n"))).alias("_r"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(F.col("_part").alias("_p"), *(F.col(k).alias(f"{k}p") for k in keys), F.last("_r", ignorenulls=True).over(before).alias("_carried"))
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}p"))
    joined = found.join(spread(carried), same, "left").select("_l.*", F.coalesce("_found", "_carried").alias("_r"))
    nothing = left.where(F.col(at).isNull()).select(*left.columns, F.lit(None).cast(kind).alias("_r"))
    return joined.unionByName(nothing).select(*left.columns, "_r.*")


def sketches(rows: DataFrame, keys: Sequence[Column | str], item: str, lg_k: int = 12) -> DataFrame:
    """A HyperLogLog sketch of the different items of every group: keys and sketch."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(F.col(item), lg_k).alias("sketch"))


def merged_counts(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimated numbers of different items for every set of ``keys`` (a cube; null where
    all values are taken together, ``level`` is the grouping's number), from stored
    sketches alone: rows are never counted again."""
    return table.cube(*keys).agg(F.grouping_id().alias("level"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
