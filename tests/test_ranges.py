from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from finloom.operators import ranges


def _intervals(seed: int, n: int, most: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, rng.choice("xyz"), a, a + rng.choice([0, 1, 3, 40, most])) for i, a in ((i, rng.randrange(most)) for i in range(n))]
    return [*rows, (n, "x", None, 5), (n + 1, None, 1, 9), (n + 2, "x", 9, 3), (n + 3, "y", 7, None), *[(n + 4 + i, "x", 50, 51) for i in range(30)]]


@pytest.mark.parametrize("bins", [1, 7, 1000])
@pytest.mark.parametrize("by", [(), ("k",)])
def test_interval_join(spark, bins, by):
    """Every overlapping pair once: points, empty and unbounded intervals, long ones, equal starts."""
    left, right = _intervals(1, 90, 300), _intervals(2, 70, 300)
    schema = "id int, k string, s long, e long"
    found = ranges.interval_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "s", "e", by, bins)
    ok = lambda r: r[2] is not None and r[3] is not None and r[2] < r[3]
    expected = Counter((a[0], b[0]) for a in left for b in right if ok(a) and ok(b) and a[2] < b[3] and b[2] < a[3] and (not by or (a[1] is not None and a[1] == b[1])))
    assert Counter((r.l_id, r.r_id) for r in found.collect()) == expected
    assert found.columns == [f"{side}_{c}" for side in "lr" for c in ("id", "k", "s", "e")]


def test_no_intervals(spark):
    none = spark.createDataFrame([], "s long, e long")
    assert ranges.interval_join(none, none, "s", "e").count() == 0
    assert ranges.interval_join(spark.createDataFrame([(1, 2)], "s long, e long"), none, "s", "e").count() == 0


def test_counts_in_intervals(spark):
    """Against every pair; a thousand points in one place make no pairs."""
    rng = random.Random(4)
    left = [*_intervals(5, 80, 300), *[(500 + i, "x", a, a + n) for i, (a, n) in enumerate([(-700, 1400), (0, 64), (-8, 16), (63, 2), (-1, 1), (5, 513)])]]
    right = [(i, rng.randrange(-600, 600)) for i in range(150)] + [(200 + i, 7) for i in range(1000)] + [(5000, None)]
    found = ranges.counts_in_intervals(spark.createDataFrame(left, "id int, k string, s long, e long"), spark.createDataFrame(right, "item int, t long"), "s", "e", "t", "item")
    expected = set()
    for i, k, a, b in left:
        held = [(item, t) for item, t in right if None not in (a, b, t) and a <= t < b]
        if held:
            expected.add((i, k, a, b, len(held), min(x for x, _ in held), max(t for _, t in held)))
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(expected) and set(rows) == expected


@pytest.mark.parametrize("by", [("k",), ("k", "j"), ()])
def test_as_of(spark, by):
    """A key in half of all rows over many ranges, ties, nulls in keys and times, keys without right rows."""
    rng = random.Random(3)
    key = lambda: rng.choice(["hot", "hot", "hot", "b", None, "c"])
    left = [(i, key(), rng.randrange(2), rng.randrange(200)) for i in range(150)] + [(900, "hot", 0, None), (901, "only left", 0, 5)]
    right = [(i, key(), rng.randrange(2), rng.randrange(200)) for i in range(120)] + [(800, "hot", 0, None), (801, "b", 1, 3), (802, "b", 1, 3)]
    schema = "id int, k string, j int, t int"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = ranges.as_of_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema).select("k", "j", "t", F.col("id").alias("v")).select(*by, "t", "v"), "t", by, ["v"])
        rows = {r.id: (r.r_v, r.r_t) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    place = {"k": 1, "j": 2}
    groups = defaultdict(list)
    for r in right:
        if r[3] is not None:
            groups[tuple(r[place[c]] for c in by)].append((r[3], r[0]))
    expected = {}
    for r in left:
        at = [x for x in groups[tuple(r[place[c]] for c in by)] if r[3] is not None and x[0] <= r[3]]
        expected[r[0]] = (max(at)[1], max(at)[0]) if at else (None, None)
    assert rows == expected


def test_sketches(spark):
    """Merged upwards, estimates stay near the exact numbers; items that groups share count once."""
    rows = spark.range(60_000).select((F.col("id") % 5).alias("day"), (F.col("id") % 3).alias("kind"), (F.col("id") % 20_011).alias("user"))
    daily = ranges.sketches(rows, ["day", "kind"], "user")
    found = {(r.day, r.kind, r.level): r.n_distinct for r in ranges.merged_counts(daily, ["day", "kind"]).collect()}
    exact = {(r.day, r.kind, r.level): r.n for r in rows.cube("day", "kind").agg(F.grouping_id().alias("level"), F.countDistinct("user").alias("n")).collect()}
    assert found.keys() == exact.keys() and len(exact) == 24
    assert all(abs(found[k] - n) <= 0.05 * n for k, n in exact.items())
