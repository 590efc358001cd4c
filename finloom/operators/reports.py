"""Reports over runs, plans and stored graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.operators.dedup import batches


def numbered(df: DataFrame, order: Sequence[str], name: str = "number") -> DataFrame:
    """Rows numbered from 1 in the given order, without one task for all rows."""
    return batches(df, order, 1).withColumn(name, F.col("batch") + 1).drop("batch")


def status_mismatches(tasks: DataFrame, issues: DataFrame) -> DataFrame:
    """Tasks (id, issue, status) that are done while their issue (number, state)
    is open, or the other way round; and those without an issue."""
    joined = tasks.join(issues, F.col("issue") == F.col("number"), "left")
    done, closed = F.col("status") == "done", F.col("state") == "closed"
    problem = (
        F.when(F.col("issue").isNull(), "no issue")
        .when(F.col("state").isNull(), "unknown issue")
        .when(done & ~closed, "done but open")
        .when(~done & closed, "closed but not done")
    )
    return joined.select("id", problem.alias("problem")).where(F.col("problem").isNotNull())


def label_violations(labels: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """label and problem of labels that don't start with a capital or aren't allowed."""
    first = F.substring("label", 1, 1)
    problem = F.when(first != F.upper(first), "not in capitals").when(~F.col("label").isin(*allowed), "unknown")
    return labels.select("label", problem.alias("problem")).where(F.col("problem").isNotNull()).distinct()


def chunk_links(facts: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For facts (id, source): each source's first chunk (chunks: id, source), or a
    new one named after it; returns the links (src, dst) and the new chunks."""
    first = chunks.groupBy("source").agg(F.min("id").alias("chunk"))
    joined = facts.join(first, "source", "left").withColumn("made", F.col("chunk").isNull())
    joined = joined.withColumn("chunk", F.coalesce("chunk", F.concat("source", F.lit("_chunk_0"))))
    return joined.select(F.col("id").alias("src"), F.col("chunk").alias("dst")).distinct(), joined.where("made").select(F.col("chunk").alias("id"), "source").distinct()


def stage_counts(stages: DataFrame) -> DataFrame:
    """Counts of every status of every stage (stage, status), and each stage's failures."""
    return stages.groupBy("stage").agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") != "success").alias("failed")
    )


def layered_counts(resolved: DataFrame) -> DataFrame:
    """One row: total, resolved and new of the result of a resolution (match, layer), and counts by layer as a map."""
    by = resolved.groupBy("layer").agg(F.count("*").alias("n"))
    return by.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("layer") != "new", F.col("n"))), F.lit(0)).alias("resolved"),
        F.coalesce(F.sum(F.when(F.col("layer") == "new", F.col("n"))), F.lit(0)).alias("new"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("layer", "n")))).alias("by_layer"),
    )


def sample_pairs(nodes: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """n pairs of different nodes (id), the same for the same nodes and seed: a
    sampling operator, by hashes rather than by chance.  2 n nodes are taken as
    a top-k, and neighbours in the order of their hashes are paired."""
    picked = nodes.select("id", F.xxhash64("id", F.lit(seed)).alias("h")).distinct().orderBy("h", "id").limit(2 * n)
    placed = numbered(picked, ["h", "id"])
    pair = F.floor((F.col("number") - 1) / 2)
    return placed.groupBy(pair.alias("pair")).agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("a", "b")


def source_table(runs: DataFrame) -> DataFrame:
    """Reports, errors and seconds of every source of a run (source, ok, seconds)."""
    return runs.groupBy("source").agg(F.count_if("ok").alias("reports"), F.count_if(~F.col("ok")).alias("errors"), F.round(F.sum("seconds"), 2).alias("seconds"))


def discoverability(distances: DataFrame) -> DataFrame:
    """One row of pairs and their distances (null: not reached): mean_path,
    diversity (different distances a reached pair) and reached (share); 0 without pairs."""
    share = lambda part, whole: F.coalesce(F.round(F.try_divide(part, whole), 4), F.lit(0.0))
    return distances.agg(
        F.count("*").alias("pairs"),
        F.coalesce(F.round(F.avg("distance"), 2), F.lit(0.0)).alias("mean_path"),
        share(F.countDistinct("distance"), F.count("distance")).alias("diversity"),
        share(F.count("distance"), F.count("*")).alias("reached"),
    )
