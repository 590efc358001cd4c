"""State, history and upsert queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom import snapshots
from finloom.operators import chains, dedup, grouping
from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import shared_dir

NOW, RETRIES, BUDGET = "2024-01-20 00:00:00", 8, 150.0


@query("""
SELECT user_id, count(*) AS total, count(*) FILTER (event_type <> 'error') AS success, count(*) FILTER (event_type = 'error') AS failed,
  round(100.0 * count(*) FILTER (event_type <> 'error') / count(*), 1) AS rate FROM events GROUP BY 1""")
def scrape_state_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.rates(table(spark, sf_dir, "events"), [F.col("user_id")], F.col("event_type") != "error")


@query(f"""
SELECT user_id, count(*) AS retries, max(ts)::DATE AS last_day FROM events WHERE event_type = 'error'
GROUP BY 1 HAVING count(*) < {RETRIES} ORDER BY max(ts), user_id LIMIT 50""")
def pending_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty oldest entries with fewer failures than the limit."""
    failed = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("retries"), F.max("ts").alias("at"))
    return failed.where(F.col("retries") < RETRIES).orderBy("at", "user_id").limit(50).select("user_id", "retries", F.to_date("at").alias("last_day"))


@query("""
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1""")
def upsert_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return dedup.latest_wins(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""
SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS success, count(*) FILTER (event_type <> 'purchase') AS retries,
  max(ts)::DATE AS day FROM events GROUP BY 1""")
def upsert_sticky_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = dedup.sticky_state(table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "purchase", "ts")
    return state.select("user_id", "success", "retries", F.to_date("updated").alias("day"))


@query(f"""
SELECT e.event_id, e.user_id FROM events e WHERE e.event_type = 'view' AND NOT EXISTS (
  SELECT 1 FROM events h WHERE h.event_type = 'purchase' AND h.user_id = e.user_id AND h.ts >= TIMESTAMP '{NOW}')""")
def history_ttl_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of users without a purchase since the cutoff."""
    events = table(spark, sf_dir, "events")
    views, seen = events.where("event_type = 'view'").select("event_id", "user_id"), events.where("event_type = 'purchase'")
    return dedup.unseen(views, seen, "user_id", "ts", NOW, null_is_seen=True).select("event_id", "user_id")


@query(f"""
WITH RECURSIVE o AS (SELECT user_id, CAST(ts AS DATE) AS day, value, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT user_id, day, i, CASE WHEN value <= {BUDGET} THEN value ELSE 0 END AS used, CASE WHEN value <= {BUDGET} THEN 1 ELSE 0 END AS accepted,
    CASE WHEN value <= {BUDGET} THEN 0 ELSE 1 END AS rejected FROM o WHERE i = 1
  UNION ALL SELECT o.user_id, o.day, o.i, CASE WHEN f.used + o.value <= {BUDGET} THEN f.used + o.value ELSE f.used END,
    f.accepted + CASE WHEN f.used + o.value <= {BUDGET} THEN 1 ELSE 0 END, f.rejected + CASE WHEN f.used + o.value <= {BUDGET} THEN 0 ELSE 1 END
  FROM f JOIN o ON o.user_id = f.user_id AND o.day = f.day AND o.i = f.i + 1)
SELECT user_id, day, CAST(arg_max(accepted, i) AS BIGINT) AS accepted, CAST(arg_max(rejected, i) AS BIGINT) AS rejected,
  round(arg_max(used, i), 2) AS used, round(greatest(0, {BUDGET} - arg_max(used, i)), 2) AS remaining FROM f GROUP BY 1, 2""")
def daily_quota_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of a user's day in order; one over the budget is rejected and not added."""
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", "value")
    return chains.quota_fold(events, ["user_id", "day"], ["ts", "event_id"], "value", BUDGET)


@query("""
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events) WHERE place <= 3""")
def retention_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return dedup.keep_newest(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3).select("user_id", "event_id")


@query("""
WITH old AS (SELECT event_type AS label, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
new AS (SELECT event_type AS label, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type <> 'signup' GROUP BY 1)
SELECT coalesce(old.label, new.label) AS label, coalesce(old.n, 0) AS n_source, coalesce(new.n, 0) AS n_target,
  CASE WHEN coalesce(old.n, 0) = coalesce(new.n, 0) THEN 'OK' ELSE 'MISMATCH' END AS verdict
FROM old FULL JOIN new ON old.label = new.label""")
def migration_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of labels on both sides of a copy."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.to_timestamp(F.lit("2024-01-16"))
    count = lambda df, name: df.groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias(name))
    both = count(events.where(early), "n_source").join(count(events.where(~early & (F.col("event_type") != "signup")), "n_target"), "label", "full_outer")
    both = both.select("label", F.coalesce("n_source", F.lit(0)).cast("long").alias("n_source"), F.coalesce("n_target", F.lit(0)).cast("long").alias("n_target"))
    return both.withColumn("verdict", F.when(F.col("n_source") == F.col("n_target"), "OK").otherwise("MISMATCH"))


@query("""
WITH c AS (SELECT user_id, event_type, ts, event_id FROM events WHERE event_type IN ('click', 'error')),
latest AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS label FROM c GROUP BY 1)
SELECT e.event_id, coalesce(l.label, e.event_type) AS label FROM events e LEFT JOIN latest l USING (user_id)""")
def reclassify_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows take the latest classification of their key, if there is one."""
    events = table(spark, sf_dir, "events")
    changes = events.where(F.col("event_type").isin("click", "error")).select("user_id", "event_type", "ts", "event_id")
    latest = dedup.latest_wins(changes, ["user_id"], ["ts", "event_id"]).select("user_id", F.col("event_type").alias("label"))
    return events.join(latest, "user_id", "left").select("event_id", F.coalesce("label", "event_type").alias("label"))


@query("""
SELECT date_trunc('hour', ts)::VARCHAR AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: counts of hours."""
    events = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return events.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("""
WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, session""")
def session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: sessions of users with gaps under six hours."""
    events = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return events.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT event_id, CAST(floor((event_id_rank - 1) / 900) AS BIGINT) AS batch FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS event_id_rank FROM events)")
def fixed_size_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in batches of 900, in order."""
    return dedup.batches(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 900).select("event_id", "batch")


@query("""
SELECT s_suppkey AS key, CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) ELSE s_name END AS name, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS version FROM supplier
UNION ALL SELECT -c_custkey - 1, c_name, 2 FROM customer""")
def committed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of suppliers after a second commit that changes a third and adds customers."""
    path = shared_dir(spark, "committed-index")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    snapshots.upsert_snapshot(rows.withColumn("version", F.lit(1)), path, "key")
    added = table(spark, sf_dir, "customer").select((-F.col("c_custkey") - 1).alias("key"), F.col("c_name").alias("name"))
    changes = rows.where("key % 3 = 0").withColumn("name", F.upper("name")).unionByName(added)
    snapshots.upsert_snapshot(changes.withColumn("version", F.lit(2)), path, "key")
    return snapshots.read_snapshot(spark, path)
