"""Operators on ordered rows: chains, trends, returns, folds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from pyspark.sql.window import Window

from finloom.functions.finance import change_pct, direction
from finloom.storage import materialise


def chain(df: DataFrame, group: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Neighbouring rows of every group: group columns and ``prev_x``, ``x`` for
    each x in ``carry``; the first row of a group makes no pair."""
    w = Window.partitionBy(*group).orderBy(*order)
    linked = df.select(*group, *carry, *[F.lag(c).over(w).alias(f"prev_{c}") for c in carry], F.row_number().over(w).alias("_at"))
    return linked.where("_at > 1").drop("_at")


def trend_edges(df: DataFrame, group: Sequence[str], order: Sequence[str], period: str, value: str) -> DataFrame:
    """Chain of periods with change_pct and direction; a pair with a null value
    is left out and not bridged."""
    pairs = chain(df, group, order, [period, value]).where(F.col(value).isNotNull() & F.col(f"prev_{value}").isNotNull())
    pct = change_pct(F.col(f"prev_{value}"), F.col(value))
    return pairs.select(*group, f"prev_{period}", period, pct.alias("change_pct"), direction(pct).alias("direction"))


def as_of_return(prices: DataFrame, group: str, at: str, price: str, start: str, end: str) -> DataFrame:
    """Per group the price at or before ``start`` and ``end`` and the change in
    per cent, two digits; null where a price is missing or the first is 0.  One
    aggregation: no join and no sort."""
    by = lambda day: F.max_by(price, F.when(F.col(at) <= F.to_timestamp(F.lit(day)), F.struct(at, price)))
    both = prices.groupBy(group).agg(by(start).alias("first_price"), by(end).alias("last_price"))
    return both.withColumn(
        "return_pct",
        F.when(F.col("first_price") != 0, F.round((F.col("last_price") / F.col("first_price") - 1) * 100, 2)),
    )


def horizon_returns(df: DataFrame, group: Sequence[str], order: str, value: str, horizons: Sequence[int]) -> DataFrame:
    """Return over each number of rows, four digits."""
    w = Window.partitionBy(*group).orderBy(order)
    back = {n: F.lag(value, n).over(w) for n in horizons}
    return df.select(
        *group, order, *[F.round(F.when(p != 0, F.col(value) / p - 1), 4).alias(f"return_{n}") for n, p in back.items()]
    )


def moving_bands(df: DataFrame, group: Sequence[str], order: str, value: str, n: int, width: float = 2.0) -> DataFrame:
    """Moving mean of the last n rows and bands of ``width`` population deviations; null for fewer rows."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(-(n - 1), 0)
    full = F.count(value).over(w) == n
    mean, dev = F.avg(value).over(w), F.stddev_pop(value).over(w)
    return df.select(
        *group,
        order,
        F.when(full, F.round(mean, 6)).alias("sma"),
        F.when(full, F.round(mean + width * dev, 6)).alias("upper"),
        F.when(full, F.round(mean - width * dev, 6)).alias("lower"),
    )


def exponential_mean(df: DataFrame, group: Sequence[str], order: str, value: str, span: int) -> DataFrame:
    """Exponential mean that starts at the first value of a group; null from a null value on.

    Rows are sorted into ranges, which cut large groups.  A range folds its part
    of a group from 0; what comes before it enters with a weight that falls row
    by row, once the ends of all ranges (one row each and group) are known.
    """
    beta = 1 - 2.0 / (span + 1)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, mean, weight, first, n = None, 0.0, 1.0, None, 0
        for batch in batches:
            keys = list(zip(*(c.to_pylist() for c in batch.columns[:-2])))
            means, weights, firsts, places = [], [], [], []
            for key, x in zip(keys, batch.column(batch.num_columns - 1).to_pylist()):
                if key != now:
                    now, mean, weight, first = key, 0.0, 1.0, x
                mean = None if mean is None or x is None else (1 - beta) * x + beta * mean
                weight *= beta
                n += 1
                means.append(mean), weights.append(weight), firsts.append(first), places.append(n)
            arrays = [*batch.columns[:-1], pa.array(means, pa.float64()), pa.array(weights, pa.float64()), pa.array(firsts, pa.float64())]
            arrays += [pa.array(places, pa.int64()), pa.array([part] * len(keys), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, [*group, order, "_mean", "_weight", "_first", "_at", "_part"])

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = None, None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            carried = []
            for *key, _, mean, weight, first in zip(*columns):
                if key != now:
                    now, before = key, first
                carried.append(before)
                before = None if before is None or mean is None else mean + weight * before
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(group) + 1], pa.array(carried, pa.float64())], [*group, "_part", "_carried"])

    kinds = dict(df.dtypes)
    keys = ", ".join(f"`{c}` {kinds[c]}" for c in group)
    rows = df.select(*group, order, F.col(value).cast("double").alias("_value"))
    sorted_rows = rows.repartitionByRange(*group, order).sortWithinPartitions(*group, order)
    folded = materialise(sorted_rows.mapInArrow(fold, f"{keys}, `{order}` {kinds[order]}, _mean double, _weight double, _first double, _at long, _part int"), "exponential-mean")
    last = [F.max_by(c, "_at").alias(c) for c in ("_mean", "_weight", "_first")]
    ends = folded.groupBy(*group, "_part").agg(*last)
    carried = ends.repartition(*group).sortWithinPartitions(*group, "_part").mapInArrow(carry, f"{keys}, _part int, _carried double")
    named = carried.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("_part").alias("_of"), "_carried")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group], F.col("_part") == F.col("_of"))
    return folded.join(named, same).select(*group, order, F.round(F.col("_mean") + F.col("_weight") * F.col("_carried"), 6).alias("ema"))


def quota_fold(df: DataFrame, group: Sequence[str], order: Sequence[str], units: str, budget: float) -> DataFrame:
    """accepted, rejected (counts) and used of every group when requests are
    taken in order and one that would pass the budget is rejected, leaving the
    total as it was.

    Whether a request fits depends on all before it, so the requests of a group
    stream through one task, which holds three numbers.  Requests over the whole
    budget are counted before that; one without units is rejected.
    """
    hopeless = df.where(F.col(units) > budget).groupBy(*group).agg(F.count("*").alias("_hopeless"))
    taken = df.where(F.coalesce(F.col(units) <= budget, F.lit(True))).select(*group, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(units).cast("double").alias("_u"))
    places = [f"_o{i}" for i in range(len(order))]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, [0.0, 0, 0]
        done: list[tuple] = []
        for batch in batches:
            for *key, u in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now is not None:
                        done.append((*now, *state))
                    now, state = key, [0.0, 0, 0]
                if u is not None and state[0] + u <= budget:
                    state[0] += u
                    state[1] += 1
                else:
                    state[2] += 1
            if done:
                yield batch_of(done)
                done = []
        if now is not None:
            yield batch_of([*done, (*now, *state)])

    schema = StructType([*(df.schema[c] for c in group), StructField("used", DoubleType()), StructField("accepted", LongType()), StructField("rejected", LongType())])
    arrow = to_arrow_schema(schema)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], arrow.names)

    folded = taken.repartition(*group).sortWithinPartitions(*group, *places, "_u").select(*group, "_u").mapInArrow(fold, schema)
    counted = hopeless.select(*[F.col(c).alias(f"_{c}") for c in group], "_hopeless")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])
    both = folded.join(counted, same, "full_outer")
    used = F.coalesce("used", F.lit(0.0))
    return both.select(
        *[F.when(F.col("accepted").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in group],
        F.coalesce("accepted", F.lit(0)).cast("long").alias("accepted"),
        (F.coalesce("rejected", F.lit(0)) + F.coalesce("_hopeless", F.lit(0))).cast("long").alias("rejected"),
        F.round(used, 2).alias("used"),
        F.round(F.greatest(F.lit(0.0), budget - used), 2).alias("remaining"),
    )


def best_and_worst(df: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    """The k best and k worst rows with ``side`` and ``place``; the two overlap
    if there are fewer than 2 k.  Each side is a top-k, never a full sort."""
    def side(name: str, order: Sequence[Column]) -> DataFrame:
        top = df.orderBy(*order).limit(k)
        return top.withColumn("side", F.lit(name)).withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))

    return side("top", [F.col(value).desc_nulls_last(), F.col(tie)]).unionByName(side("bottom", [F.col(value).asc_nulls_first(), F.col(tie)]))
