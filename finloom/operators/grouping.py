"""Counts, rates and the measures of a graph's quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Grades of measures as (green, yellow) and those where less is better.
THRESHOLDS = {
    "node_count": (3000.0, 1000.0),
    "relationship_count": (5000.0, 2000.0),
    "avg_degree": (3.0, 1.5),
    "connected_component_ratio": (0.9, 0.7),
    "orphan_node_ratio": (0.05, 0.15),
    "orphan_entity_count": (50.0, 200.0),
    "property_fill_rate": (0.8, 0.6),
    "required_property_coverage": (0.95, 0.8),
    "label_consistency": (0.95, 0.8),
    "entity_type_coverage": (0.9, 0.7),
    "source_freshness_days": (7.0, 30.0),
    "claim_evidence_ratio": (0.8, 0.5),
    "financial_data_completeness": (0.7, 0.4),
    "path_reachability": (0.6, 0.3),
}
LESS_IS_BETTER = ("source_freshness_days", "orphan_node_ratio", "orphan_entity_count")


def rates(df: DataFrame, by: Sequence[Column], success: Column) -> DataFrame:
    """total, success, failed and rate in per cent (one digit) of every group."""
    return df.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(success).alias("success")).withColumn(
        "failed", F.col("total") - F.col("success")
    ).withColumn("rate", F.round(100.0 * F.col("success") / F.col("total"), 1))


def fixed_buckets(df: DataFrame, by: Column, names: Sequence[str]) -> DataFrame:
    """bucket and n for every name, zeros included; other values don't count."""
    names_df = df.sparkSession.createDataFrame([(n,) for n in names], "bucket string")
    counts = df.groupBy(by.alias("bucket")).agg(F.count("*").alias("n"))
    return names_df.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column and fill_rate: the share of rows neither null nor blank, in one pass."""
    filled = df.agg(*[F.avg(F.coalesce((F.trim(F.col(c).cast("string")) != "").cast("double"), F.lit(0.0))).alias(c) for c in columns])
    return filled.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.round(c, 4).alias("fill_rate")) for c in columns])))


def entropy(df: DataFrame, by: str, label: str) -> DataFrame:
    """Shannon entropy of the counts of ``by``, divided by the logarithm of the
    number of kinds; 0 for one kind or none."""
    counts = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").cast("double").alias("n"))
    sums = counts.agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("weighted"), F.count("*").alias("kinds"))
    plain = F.log2("total") - F.col("weighted") / F.col("total")
    return sums.select(
        F.lit(label).alias("distribution"),
        F.when(F.col("kinds") > 1, F.round(plain / F.log2(F.col("kinds").cast("double")), 4)).otherwise(0.0).alias("entropy"),
    )


def metric_status(name: Column, value: Column, thresholds: Mapping[str, tuple[float, float]] = THRESHOLDS) -> Column:
    """green, yellow or red; a measure without thresholds is yellow."""
    out = F.lit("yellow")
    for metric, (green, yellow) in thresholds.items():
        better = (lambda limit: value <= limit) if metric in LESS_IS_BETTER else (lambda limit: value >= limit)
        graded = F.when(better(green), "green").when(better(yellow), "yellow").otherwise("red")
        out = F.when(name == metric, graded).otherwise(out)
    return out


def status_score(status: Column) -> Column:
    return F.when(status == "green", 100.0).when(status == "yellow", 50.0).otherwise(0.0)


def grade(score: Column) -> Column:
    return F.when(score >= 80, "A").when(score >= 60, "B").when(score >= 40, "C").otherwise("D")


def rule_result(df: DataFrame, rule: str, violates: Column) -> DataFrame:
    """rule, total, violations and pass_rate (four digits, 1 for no rows)."""
    return df.agg(F.count("*").alias("total"), F.count_if(F.coalesce(violates, F.lit(False))).alias("violations")).select(
        F.lit(rule).alias("rule"),
        "total",
        "violations",
        F.when(F.col("total") == 0, 1.0).otherwise(F.round(1 - F.col("violations") / F.col("total"), 4)).alias("pass_rate"),
    )


def compare_snapshots(previous: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """Both values and their difference by key; a missing one counts as 0."""
    side = lambda df, name: df.select(key, F.col(value).alias(name))
    both = side(previous, "before").join(side(current, "after"), key, "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return both.select(key, zero("before").alias("before"), zero("after").alias("after"), F.round(zero("after") - zero("before"), 4).alias("change"))


def alerts(compared: DataFrame, rules: DataFrame, orphans: DataFrame) -> DataFrame:
    """name, severity and value of the alerts: a score (compared: name, before,
    after) that fell by 10 or 5; a pass rate (rules: rule, pass_rate) under 0.95;
    a number of orphans (orphans: n) of 200 or 50."""
    drop = F.col("before") - F.col("after")
    fell = compared.where(drop >= 5).select(
        F.concat(F.lit("score_"), "name").alias("name"), F.when(drop >= 10, "critical").otherwise("warning").alias("severity"), F.col("after").cast("double").alias("value")
    )
    failed = rules.where("pass_rate < 0.95").select(F.concat(F.lit("rule_"), "rule").alias("name"), F.lit("warning").alias("severity"), F.col("pass_rate").alias("value"))
    alone = orphans.where("n >= 50").select(
        F.lit("orphan_entities").alias("name"), F.when(F.col("n") >= 200, "critical").otherwise("warning").alias("severity"), F.col("n").cast("double").alias("value")
    )
    return fell.unionByName(failed).unionByName(alone)


def weighted_completeness(df: DataFrame, by: str, text: str, checks: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Per group the number of satisfied checks and their share of all weights;
    a check (name, pattern, weight) holds if a text of the group has the pattern.
    One pass, one flag a check."""
    flags = [F.max(F.col(text).rlike("(?i)" + pattern).cast("int")) for _, pattern, _ in checks]
    total = float(sum(w for *_, w in checks))
    found = df.groupBy(by).agg(*[F.coalesce(f, F.lit(0)).alias(f"c{i}") for i, f in enumerate(flags)])
    score = sum((F.col(f"c{i}") * w for i, (*_, w) in enumerate(checks)), F.lit(0)) / total
    return found.select(by, sum((F.col(f"c{i}") for i in range(len(checks))), F.lit(0)).cast("long").alias("satisfied"), F.round(score, 4).alias("score"))
