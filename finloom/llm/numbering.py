"""Places of rows in a global order, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.llm.common import materialise

_ROWS_OF_A_PART = (1 << 33) - 1


def numbered(table: DataFrame, groups: Sequence[str], order: Sequence[Column], label: str) -> DataFrame:
    """The columns of ``table`` with position (from 0, in its group) and n (rows of the group).

    Rows are sorted by ranges of (groups, order) and written, each with the part
    it is in and its place there; a table of one row a part and group then says
    how many rows of the group come before the part.  Groups may be null, which
    is a group of its own.  Rows that tie in all of ``order`` share a range, so
    ``order`` should end in something that tells the rows of a large tie apart.
    """
    own = list(table.columns)
    keys = [*(F.col(g).asc_nulls_first() for g in groups), *order]
    at = F.monotonically_increasing_id()
    ranges = table.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(ranges.select(*own, at.alias("at")).select("*", F.shiftright("at", 33).alias("part")), label)
    counts = placed.groupBy("part", *groups).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    # One row a part and group: some thousands, however many rows there are.
    group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", *groups, (before - F.col("first")).alias("shift"), F.sum("rows").over(group).alias("n"))
    same = F.col("p.part") == F.col("s.part")
    for g in groups:
        same &= F.col(f"p.{g}").eqNullSafe(F.col(f"s.{g}"))
    return placed.alias("p").join(starts.alias("s"), same).select(
        *(F.col(f"p.{c}") for c in own), (F.col("p.at") + F.col("s.shift")).alias("position"), "s.n"
    )
