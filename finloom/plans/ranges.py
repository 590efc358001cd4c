"""Queries of joins on ranges and of sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators import ranges
from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import materialise

_DAY = 86_400_000
_FIRST = 1_704_067_200_000
_PERIODS = f"""SELECT o_orderkey, {_FIRST} + (epoch_us(o_orderdate) // {_DAY}000) % 30 * {_DAY} + o_orderkey % 24 * 3600000 AS a, 1200000 + o_orderkey % 7 * 600000 AS n FROM orders"""


@query(f"""
WITH p AS ({_PERIODS}), e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
SELECT o_orderkey, count(*) AS n_events, min(event_id) AS first_event, max(ms) AS last_ms FROM p JOIN e ON ms >= a AND ms < a + n GROUP BY 1""")
def events_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that fall into the delivery periods of orders."""
    day = F.floor(F.unix_millis(F.col("o_orderdate").cast("timestamp")) / _DAY)
    start = F.lit(_FIRST) + day % 30 * _DAY + F.col("o_orderkey") % 24 * 3_600_000
    periods = table(spark, sf_dir, "orders").select("o_orderkey", start.alias("a"), (start + 1_200_000 + F.col("o_orderkey") % 7 * 600_000).alias("b"))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    points = table(spark, sf_dir, "events").select("event_id", ms.alias("at"))
    found = ranges.counts_in_intervals(periods, points, "a", "b", "at", "event_id")
    return found.groupBy("o_orderkey").agg(F.sum("n_points").alias("n_events"), F.min("first_item").alias("first_event"), F.max("last_at").alias("last_ms"))


@query("""
WITH u AS (SELECT event_id, user_id, ts, event_type = 'signup' AS signup FROM events),
w AS (SELECT *, last_value(CASE WHEN signup THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, NOT signup, event_id ROWS UNBOUNDED PRECEDING) AS signed_by FROM u)
SELECT event_id, user_id, signed_by FROM w WHERE NOT signup""")
def events_after_signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its user's last signup before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    signups = events.where("event_type = 'signup'").select("user_id", "ts", "event_id")
    found = ranges.as_of_join(events.where("event_type <> 'signup'").drop("event_type"), signups, "ts", ["user_id"], ["event_id"])
    return found.select("event_id", "user_id", F.col("r_event_id").alias("signed_by"))


@query("""
SELECT CAST(ts AS DATE) AS day, event_type, CAST(grouping(CAST(ts AS DATE)) * 2 + grouping(event_type) AS BIGINT) AS level, count(*) AS n_events, true AS near
FROM events GROUP BY CUBE (CAST(ts AS DATE), event_type)""")
def distinct_users_by_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different users by day and kind, from daily sketches: whether each estimate is within
    5 % (and one) of the exact number."""
    events = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id")
    daily = materialise(ranges.sketches(events, ["day", "event_type"], "user_id"), "daily-sketches")
    exact = events.cube("day", "event_type").agg(F.grouping_id().alias("level"), F.count("*").alias("n_events"), F.countDistinct("user_id").alias("n"))
    same = F.col("e.day").eqNullSafe(F.col("m.day")) & F.col("e.event_type").eqNullSafe(F.col("m.event_type")) & (F.col("e.level") == F.col("m.level"))
    both = exact.alias("e").join(ranges.merged_counts(daily, ["day", "event_type"]).alias("m"), same)
    near = F.abs(F.col("n_distinct") - F.col("n")) <= F.col("n") * 0.05 + 1
    return both.select("e.day", "e.event_type", "e.level", "n_events", near.alias("near"))
