"""Keyed state with event-time timers: retries that come due, budgets that start anew at midnight.

Rows wait in the state of their key until the watermark has passed them and are
then taken in the order of their times, so a result doesn't depend on how the
input was cut into batches, on its order within the watermark, or on restarts.
Needs the RocksDB state store (``timed_state`` sets it).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import shared_dir
from finloom.streaming.incremental import run_once, stream_of

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
_ROW = np.dtype([("ms", "<i8"), ("x", "<f8")])


def _block(ms: pd.Series, x: pd.Series) -> np.ndarray:
    block = np.empty(len(ms), _ROW)
    block["ms"], block["x"] = ms, x
    return block


@contextmanager
def timed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, for streams that start inside."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


class _InOrder(StatefulProcessor):
    """Takes the rows (time in ms, number) of a key in order as the watermark passes them."""

    names: list[str] = []
    progress: str = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Rows wait in blocks, one for what a batch brings: each value is a call to the JVM.
        self.waiting = handle.getListState("waiting", "block binary")
        self.state = handle.getValueState("state", self.progress)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = np.concatenate([_block(part["ms"], part["x"]) for part in rows])
        mark, first = timerValues.getCurrentWatermarkInMs(), int(new["ms"].min())
        self.waiting.appendList([(new.tobytes(),)])
        timers = list(self.handle.listTimers())
        if first <= mark or any(t <= mark for t in timers):
            yield from self._advance(key, mark)
        elif not timers or first < min(timers):
            # Nothing is due, so what waits isn't read again.
            self._wake(timers, first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs())

    def _wake(self, timers: list[int], at: int) -> None:
        for timer in timers:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def _advance(self, key, mark: int) -> Iterator[pd.DataFrame]:
        blocks = b"".join(bytes(r[0]) for r in self.waiting.get()) if self.waiting.exists() else b""
        held = np.frombuffer(blocks, _ROW)
        held = held[np.lexsort((held["x"], held["ms"]))]
        rows = list(zip(held["ms"].tolist(), held["x"].tolist()))
        state = tuple(self.state.get()) if self.state.exists() else None
        out: list[tuple] = []
        at = 0
        while at < len(rows) and rows[at][0] <= mark:
            state = self.take(state, *rows[at], out)
            at += 1
        state = self.expire(state, mark, out)
        left = rows[at:]
        if at:
            self.waiting.clear()
            if left:
                self.waiting.put([(held[at:].tobytes(),)])
        if state is None:
            self.state.clear()
        else:
            self.state.update(state)
        timers = list(self.handle.listTimers())
        due = [t for t in (left[0][0] if left else None, self.timer(state)) if t is not None]
        if due:
            self._wake(timers, max(min(due), mark + 1))
        else:
            for timer in timers:
                self.handle.deleteTimer(timer)
        if out:
            yield pd.DataFrame([(*key, *o) for o in out], columns=self.names)

    def close(self) -> None:
        pass


class _Retries(_InOrder):
    progress = "failures int, due long"

    def __init__(self, key: str, base_ms: int, most: int):
        self.names, self.base_ms, self.most = [key, "due_ms", "failures"], base_ms, most

    def take(self, state, ms, x, out):
        failures, due = state or (0, -1)
        if 0 <= due < ms:
            out.append((due, failures))
        if x:
            return None
        failures += 1
        return failures, ms + self.base_ms * 2 ** (failures - 1) if failures <= self.most else -1

    def expire(self, state, mark, out):
        if state and 0 <= state[1] <= mark:
            out.append((state[1], state[0]))
            return state[0], -1
        return state

    def timer(self, state):
        return state[1] if state and state[1] >= 0 else None


class _DailyQuota(_InOrder):
    progress = "day long, used double, accepted long, rejected long"

    def __init__(self, key: str, budget: float):
        self.names, self.budget = [key, "day_ms", "used", "accepted", "rejected"], budget

    def take(self, state, ms, x, out):
        day = ms - ms % DAY_MS
        if state and state[0] != day:
            out.append(state)
            state = None
        _, used, accepted, rejected = state or (day, 0.0, 0, 0)
        return (day, used + x, accepted + 1, rejected) if used + x <= self.budget else (day, used, accepted, rejected + 1)

    def expire(self, state, mark, out):
        if state and state[0] + DAY_MS <= mark:
            out.append(state)
            return None
        return state

    def timer(self, state):
        return state[0] + DAY_MS if state else None


def _timed(stream: DataFrame, key: str, at: str, value, late: str) -> DataFrame:
    rows = stream.select(F.col(key), F.col(at).cast("timestamp").alias("at"), value.cast("double").alias("x"))
    return rows.where("at IS NOT NULL AND x IS NOT NULL").withColumn("ms", F.unix_millis("at")).withWatermark("at", late)


def retries_due(stream: DataFrame, key: str, at: str, ok: str, late: str, base_seconds: int, most: int = 5) -> DataFrame:
    """key, due_ms and failures: when a failed attempt is to be repeated.

    After the n-th failure in a row a retry comes due ``base_seconds`` * 2^(n-1) later,
    if no other attempt came until then; a success forgets the failures; after
    more than ``most`` failures there are no retries.  A key whose last attempt
    succeeded keeps no state.  Rows later than ``late`` may be lost, rows
    without a time or an outcome are left out.
    """
    kind = dict(stream.dtypes)[key]
    rows = _timed(stream, key, at, F.col(ok), late).groupBy(key)
    return rows.transformWithStateInPandas(_Retries(key, base_seconds * 1000, most), f"{key} {kind}, due_ms long, failures int", "Append", "eventTime")


def daily_quota(stream: DataFrame, key: str, at: str, units: str, late: str, budget: float) -> DataFrame:
    """key, day_ms (midnight, UTC), used, accepted and rejected of every day that is over.

    Requests are taken in the order of their times (then units); those that would
    pass the day's ``budget`` are rejected and not added.  A timer at midnight
    closes the day, so state holds one day a key and rows that still wait.
    """
    kind = dict(stream.dtypes)[key]
    rows = _timed(stream, key, at, F.col(units), late).groupBy(key)
    return rows.transformWithStateInPandas(_DailyQuota(key, budget), f"{key} {kind}, day_ms long, used double, accepted long, rejected long", "Append", "eventTime")


def join_in_time(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, before: str, after: str, late: str) -> DataFrame:
    """Rows of two streams with equal keys whose right time is from ``before`` the left one
    to ``after`` it; a left row without a partner comes with nulls when none can
    come any more.  Rows later than ``late`` may be lost; state older than that
    and the range is dropped.  Right columns are named r_...
    """
    a = left.withWatermark(left_at, late)
    b = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns)).withWatermark(f"r_{right_at}", late)
    near = (F.col(f"r_{right_at}") >= F.col(left_at) - F.expr(f"INTERVAL {before}")) & (F.col(f"r_{right_at}") <= F.col(left_at) + F.expr(f"INTERVAL {after}"))
    return a.join(b, (F.col(key) == F.col(f"r_{key}")) & near, "left_outer")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one batch: their files aren't in the order of their times, so in
    batches of a file rows would come later than any watermark allows."""
    events = table(spark, sf_dir, "events")
    return stream_of(spark, f"{sf_dir}/events.parquet", events.schema, 1_000_000).where("user_id IS NOT NULL")


_EVENTS = "SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, event_type, value FROM events"
_MARK = "(SELECT max(epoch_us(ts) // 1000) - 3600000 FROM e)"


@query(f"""
WITH RECURSIVE e AS MATERIALIZED ({_EVENTS}),
o AS (SELECT user_id, epoch_us(ts) // 1000 AS ms, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_type <> 'error') AS i FROM e
  WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL AND epoch_us(ts) // 1000 <= {_MARK}),
g AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY user_id ORDER BY i) AS run, lead(ms) OVER (PARTITION BY user_id ORDER BY i) AS next FROM o),
f AS (SELECT user_id, ms, next, row_number() OVER (PARTITION BY user_id, run ORDER BY i) AS failures FROM g WHERE NOT ok),
d AS (SELECT user_id, ms + 1800000 * CAST(2 ** (failures - 1) AS BIGINT) AS due_ms, next, CAST(failures AS INTEGER) AS failures FROM f WHERE failures <= 5)
SELECT user_id, due_ms, failures FROM d WHERE due_ms <= {_MARK} AND (next IS NULL OR next > due_ms)""")
def stream_retries_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retries after users' errors that came due, in a stream of events."""
    stream = _event_stream(spark, sf_dir).select("user_id", "ts", (F.col("event_type") != "error").alias("ok"))
    with timed_state(spark):
        return run_once(retries_due(stream, "user_id", "ts", "ok", "1 hour", 1800), shared_dir(spark, "stream-retries"))


@query(f"""
WITH RECURSIVE e AS MATERIALIZED ({_EVENTS}),
o AS MATERIALIZED (SELECT user_id, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 86400000 AS day_ms, abs(value) AS x,
  row_number() OVER (PARTITION BY user_id, (epoch_us(ts) // 1000) // 86400000 ORDER BY epoch_us(ts) // 1000, abs(value)) AS i FROM e WHERE user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL
  AND epoch_us(ts) // 1000 <= {_MARK}),
q AS (SELECT user_id, day_ms, i, CASE WHEN x <= 150 THEN x ELSE 0 END AS used, CAST(x <= 150 AS BIGINT) AS accepted, CAST(x > 150 AS BIGINT) AS rejected FROM o WHERE i = 1
  UNION ALL SELECT o.user_id, o.day_ms, o.i, CASE WHEN used + x <= 150 THEN used + x ELSE used END, accepted + CAST(used + x <= 150 AS BIGINT), rejected + CAST(used + x > 150 AS BIGINT)
  FROM q JOIN o ON o.user_id = q.user_id AND o.day_ms = q.day_ms AND o.i = q.i + 1)
SELECT user_id, day_ms, round(arg_max(used, i), 6) AS used, max(accepted) AS accepted, max(rejected) AS rejected FROM q WHERE day_ms + 86400000 <= {_MARK} GROUP BY 1, 2""")
def stream_daily_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users use of a daily budget, in a stream of events; days close at midnight."""
    stream = _event_stream(spark, sf_dir).select("user_id", "ts", F.abs("value").alias("value"))
    with timed_state(spark):
        found = run_once(daily_quota(stream, "user_id", "ts", "value", "1 hour", 150.0), shared_dir(spark, "stream-quota"))
    return found.withColumn("used", F.round("used", 6))


_CLICKS = "SELECT event_id, user_id, ts FROM events WHERE event_type = '{}' AND user_id IS NOT NULL"


@query(f"""
WITH a AS ({_CLICKS.format('click')}), b AS ({_CLICKS.format('purchase')}),
j AS (SELECT a.event_id, b.event_id AS bought FROM a JOIN b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR)
SELECT event_id, bought FROM j
UNION ALL SELECT event_id, NULL FROM a ANTI JOIN j ON a.event_id = j.event_id WHERE ts + INTERVAL 1 HOUR < (SELECT least((SELECT max(ts) FROM a), (SELECT max(ts) FROM b)) - INTERVAL 1 HOUR)""")
def stream_clicks_and_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with the purchases of the hour after, two streams; without one when the hour is over."""
    sides = [_event_stream(spark, sf_dir).where(F.col("event_type") == k).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts")) for k in ("click", "purchase")]
    found = join_in_time(*sides, "user_id", "ts", "ts", "0 minutes", "1 hour", "1 hour").select("event_id", F.col("r_event_id").alias("bought"))
    return run_once(found, shared_dir(spark, "stream-join"))
