"""Streams with timers give the batch's result at every split of their input, and after restarts."""

from __future__ import annotations

import datetime
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from finloom.streaming import incremental, timers

SCHEMA = "k string, at timestamp, ok boolean, n double"
START = 1_704_067_200_123
LATE_MS = 1_800_000


def _rows(seed: int, n: int = 60) -> list[tuple[str, int, bool, float]]:
    """Ordered by time but for swaps inside the lateness; some keys rest for days."""
    rng = random.Random(seed)
    at, rows = START, []
    for _ in range(n):
        at += rng.choice([1_001, 60_003, 700_007, 20_000_011])
        rows.append((rng.choice("abc"), at, rng.random() < 0.3, float(rng.randrange(1, 60))))
    for i in range(0, n - 1, 7):
        if rows[i + 1][1] - rows[i][1] < LATE_MS:
            rows[i], rows[i + 1] = rows[i + 1], rows[i]
    return rows


def _due(rows, base, most):
    mark = max(r[1] for r in rows) - LATE_MS
    groups = defaultdict(list)
    for k, at, ok, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        if at <= mark:
            groups[k].append((at, ok))
    out = set()
    for k, log in groups.items():
        failures = 0
        for i, (at, ok) in enumerate(log):
            failures = 0 if ok else failures + 1
            due = at + base * 2 ** (failures - 1) if 0 < failures <= most else None
            following = log[i + 1][0] if i + 1 < len(log) else None
            if due is not None and due <= mark and (following is None or following > due):
                out.add((k, due, failures))
    return out


def _quota(rows, budget):
    mark = max(r[1] for r in rows) - LATE_MS
    days = {}
    for k, at, _, n in sorted(rows, key=lambda r: (r[1], r[3])):
        if at <= mark:
            used, yes, no = days.get((k, at - at % timers.DAY_MS), (0.0, 0, 0))
            days[k, at - at % timers.DAY_MS] = (used + n, yes + 1, no) if used + n <= budget else (used, yes, no + 1)
    return {(k, day, *x) for (k, day), x in days.items() if day + timers.DAY_MS <= mark}


def _write(spark, path, rows):
    at = lambda ms: datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc).replace(tzinfo=None)
    df = spark.createDataFrame([(k, at(ms), ok, n) for k, ms, ok, n in rows], "k string, at timestamp_ntz, ok boolean, n double")
    df.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("split", [(60,), (1, 17, 42), (13, 14, 15, 50)])
def test_any_split(spark, tmp_path, split):
    rows = _rows(len(split))
    source = str(tmp_path / "in")
    edges = [0, *split, len(rows)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            _write(spark, source, rows[a:b])
    stream = incremental.stream_of(spark, source, SCHEMA)
    with timers.timed_state(spark):
        due = incremental.run_once(timers.retries_due(stream, "k", "at", "ok", "30 minutes", 900, 3), str(tmp_path / "due"))
        days = incremental.run_once(timers.daily_quota(stream, "k", "at", "n", "30 minutes", 100.0), str(tmp_path / "days"))
    expected, of_days = _due(rows, 900_000, 3), _quota(rows, 100.0)
    found, found_days = [tuple(r) for r in due.collect()], [tuple(r) for r in days.collect()]
    assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 3
    assert len(found_days) == len(set(found_days)) and set(found_days) == of_days and len(of_days) > 2


def test_restarts(spark, tmp_path):
    """Input that comes between runs of one checkpoint; timers of before the restart fire after it."""
    rows = _rows(9)
    source, out = str(tmp_path / "in"), str(tmp_path / "due")
    for a, b in ((0, 20), (20, 33), (33, 60)):
        _write(spark, source, rows[a:b])
        stream = incremental.stream_of(spark, source, SCHEMA)
        with timers.timed_state(spark):
            found = incremental.run_once(timers.retries_due(stream, "k", "at", "ok", "30 minutes", 900, 3), out)
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(set(found)) and set(found) == _due(rows, 900_000, 3)


def test_join_in_time(spark, tmp_path):
    """Two streams in batches equal the batch join; rows without a partner come when none can come."""
    a, b = [r for r in _rows(4, 40)], [r for r in _rows(5, 40)]
    for i in range(0, 40, 10):
        _write(spark, str(tmp_path / "a"), a[i : i + 10])
        _write(spark, str(tmp_path / "b"), b[i : i + 10])
    left, right = (incremental.stream_of(spark, str(tmp_path / x), SCHEMA).select("k", "at", "n") for x in "ab")
    joined = timers.join_in_time(left, right, "k", "at", "at", "10 minutes", "2 hours", "12 hours")
    found = incremental.run_once(joined.select("k", F.unix_millis("at").alias("a"), F.unix_millis("r_at").alias("b")), str(tmp_path / "out"))
    pairs = {(x[0], x[1], y[1]) for x in a for y in b if x[0] == y[0] and -600_000 <= y[1] - x[1] <= 7_200_000}
    mark = min(max(r[1] for r in a), max(r[1] for r in b)) - 12 * 3_600_000
    alone = {(x[0], x[1], None) for x in a if x[1] + 7_200_000 < mark} - {(k, at, None) for k, at, _ in pairs}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == pairs | alone and pairs and alone


def test_calls_of_a_key():
    """A batch of a key is one value of state, and isn't read again while nothing is due."""
    calls = []

    class Values(list):
        exists = lambda self: bool(self)
        get = lambda self: (calls.append("get"), iter(list(self)))[1]
        appendList = lambda self, new: (calls.append(("append", len(new))), self.extend(new))

    class Handle:
        timers: list[int] = []
        getListState = getValueState = lambda self, *_: Values()
        listTimers = lambda self: list(self.timers)
        registerTimer = lambda self, at: self.timers.append(at)
        deleteTimer = lambda self, at: self.timers.remove(at)

    class Mark:
        getCurrentWatermarkInMs = lambda self: 0

    quota, handle = timers._DailyQuota("k", 10.0), Handle()
    quota.init(handle)
    for first in (500, 100, 900):
        part = pd.DataFrame({"ms": range(first, first + 300), "x": 1.0})
        assert list(quota.handleInputRows(("k",), iter([part]), Mark())) == []
    assert calls == [("append", 1)] * 3 and handle.timers == [100]
