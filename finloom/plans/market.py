"""Period chains, trends, returns and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions.finance import change_pct, direction, gap_months, period_key, period_type
from finloom.operators import chains
from finloom.plans.catalog import query
from finloom.session import table


def _label():
    return F.concat(F.quarter("o_orderdate").cast("string"), F.lit("Q"), F.year("o_orderdate").cast("string"))


def _quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey", _label().alias("period"))
    return orders.agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


_QUARTERS = """SELECT o_custkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, concat(quarter(o_orderdate), 'Q', year(o_orderdate)) AS period,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2, 3, 4"""


@query(f"""
SELECT o_custkey, prev_period, period, 3 AS gap_months FROM (
  SELECT o_custkey, period, lag(period) OVER (PARTITION BY o_custkey ORDER BY y, q) AS prev_period FROM ({_QUARTERS})) WHERE prev_period IS NOT NULL""")
def next_period_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring periods of a customer and kind, with the usual gap."""
    periods = _quarters(spark, sf_dir).withColumn("kind", period_type(F.col("period"))).withColumn("key", period_key(F.col("period")))
    linked = chains.chain(periods, ["o_custkey", "kind"], ["key"], ["period"])
    return linked.select("o_custkey", "prev_period", "period", gap_months(F.col("kind")).alias("gap_months"))


@query(f"""
WITH c AS (SELECT *, lag(period) OVER w AS prev_period, lag(total) OVER w AS prev FROM ({_QUARTERS}) WINDOW w AS (PARTITION BY o_custkey ORDER BY y, q)),
p AS (SELECT o_custkey, prev_period, period, CASE WHEN prev = 0 THEN 0.0 ELSE round((total - prev) / abs(prev) * 100, 2) END AS change_pct FROM c
  WHERE prev IS NOT NULL AND total IS NOT NULL)
SELECT *, CASE WHEN change_pct > 1 THEN 'up' WHEN change_pct < -1 THEN 'down' ELSE 'flat' END AS direction FROM p""")
def trend_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change between neighbouring quarters of a customer."""
    quarters = _quarters(spark, sf_dir).withColumn("key", period_key(F.col("period")))
    return chains.trend_edges(quarters, ["o_custkey"], ["key"], "period", "total")


@query("""
SELECT o_custkey, o_orderpriority, prev_o_orderkey, o_orderkey FROM (SELECT *, lag(o_orderkey) OVER (
  PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS prev_o_orderkey FROM orders) WHERE prev_o_orderkey IS NOT NULL""")
def supersedes_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stance replaces the one before of its author and subject."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate")
    linked = chains.chain(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], ["o_orderkey"])
    return linked.select("o_custkey", "o_orderpriority", "prev_o_orderkey", "o_orderkey")


@query("""
SELECT user_id, first_price, last_price, CASE WHEN first_price <> 0 THEN round((last_price / first_price - 1) * 100, 2) END AS return_pct FROM (
  SELECT user_id, arg_max(value, (ts, value)) FILTER (ts <= TIMESTAMP '2024-01-10') AS first_price,
    arg_max(value, (ts, value)) FILTER (ts <= TIMESTAMP '2024-01-25') AS last_price FROM events GROUP BY 1)""")
def period_return_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return between the prices as of two days."""
    return chains.as_of_return(table(spark, sf_dir, "events"), "user_id", "ts", "value", "2024-01-10", "2024-01-25")


_REVENUE = """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1"""


@query(f"""
WITH r AS ({_REVENUE}),
t AS (SELECT n_name, revenue, 'top' AS side, row_number() OVER (ORDER BY revenue DESC NULLS LAST, n_name) AS place FROM r
  UNION ALL SELECT n_name, revenue, 'bottom', row_number() OVER (ORDER BY revenue ASC NULLS FIRST, n_name) FROM r)
SELECT * FROM t WHERE place <= 3""")
def top_bottom_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best and worst nations by revenue."""
    t = lambda name: table(spark, sf_dir, name)
    by_supplier = t("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("part"))
    nation = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    revenue = by_supplier.join(t("supplier"), "s_suppkey").join(nation, "s_nationkey").groupBy("n_name").agg(F.round(F.sum("part"), 2).alias("revenue"))
    return chains.best_and_worst(revenue, "revenue", "n_name", 3)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day"))
    return events.agg(F.round(F.avg("value"), 8).alias("price"))


_DAILY = "SELECT event_type, CAST(ts AS DATE) AS day, round(avg(value), 8) AS price FROM events GROUP BY 1, 2"
_HORIZONS = (1, 5, 10, 20)


@query(
    "SELECT event_type, day, "
    + ", ".join(f"round(CASE WHEN lag(price, {n}) OVER w <> 0 THEN price / lag(price, {n}) OVER w - 1 END, 4) AS return_{n}" for n in _HORIZONS)
    + f" FROM ({_DAILY}) WINDOW w AS (PARTITION BY event_type ORDER BY day)"
)
def multi_horizon_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.horizon_returns(_daily(spark, sf_dir), ["event_type"], "day", "price", _HORIZONS)


@query(f"""
SELECT event_type, day, CASE WHEN n = 20 THEN round(m, 6) END AS sma, CASE WHEN n = 20 THEN round(m + 2 * d, 6) END AS upper, CASE WHEN n = 20 THEN round(m - 2 * d, 6) END AS lower
FROM (SELECT event_type, day, count(price) OVER w AS n, avg(price) OVER w AS m, stddev_pop(price) OVER w AS d FROM ({_DAILY})
  WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""")
def sma_bollinger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: moving mean and bands of daily prices."""
    return chains.moving_bands(_daily(spark, sf_dir), ["event_type"], "day", "price", 20)


@query(f"""
WITH RECURSIVE d AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i FROM ({_DAILY})),
e AS (SELECT event_type, day, i, price AS v FROM d WHERE i = 1
  UNION ALL SELECT d.event_type, d.day, d.i, (2.0 / 11) * d.price + (1 - 2.0 / 11) * e.v FROM e JOIN d ON d.event_type = e.event_type AND d.i = e.i + 1)
SELECT event_type, day, round(v, 6) AS ema FROM e""")
def ema_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: exponential mean of daily prices."""
    return chains.exponential_mean(_daily(spark, sf_dir), ["event_type"], "day", "price", 10)


@query("""
WITH m AS (SELECT o_orderpriority AS metric, round(avg(CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN o_totalprice END), 6) AS before,
  round(avg(CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_totalprice END), 6) AS after FROM orders GROUP BY 1)
SELECT metric, change_pct, CASE WHEN change_pct > 1 THEN 'up' WHEN change_pct < -1 THEN 'down' ELSE 'flat' END AS direction
FROM (SELECT metric, CASE WHEN before = 0 THEN 0.0 ELSE round((after - before) / abs(before) * 100, 2) END AS change_pct FROM m)""")
def regression_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means before and after a day, with the direction of the change."""
    day = F.to_timestamp(F.lit("2000-01-01"))
    mean = lambda keep: F.round(F.avg(F.when(keep, F.col("o_totalprice"))), 6)
    means = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("metric")).agg(
        mean(F.col("o_orderdate") < day).alias("before"), mean(F.col("o_orderdate") >= day).alias("after")
    )
    pct = change_pct(F.col("before"), F.col("after"))
    return means.select("metric", pct.alias("change_pct"), direction(pct).alias("direction"))
