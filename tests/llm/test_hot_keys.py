"""A key in half of all rows: adaptive execution splits the joins that meet it."""

from __future__ import annotations

from pyspark.sql import functions as F

from finloom.llm import jaccard_join, line_dedup, quality_rules, substring_dedup, warc
from finloom.llm.common import spread
from finloom.operators.graph import _large_star
from tests.llm.helpers import executed, many_partitions


def test_spread(spark):
    with many_partitions(spark):
        rows = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        low = rows.groupBy(F.col("k").alias("f")).agg(F.min("v").alias("low"))
        assert "skew=true" in executed(rows.join(spread(low), F.col("k") == F.col("f")))


def test_a_hub(spark):
    with many_partitions(spark):
        edges = spark.range(1, 40_000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") - 1).alias("b")).toDF("a", "b")
        assert "skew=true" in executed(_large_star(edges))


def test_a_line_window(spark):
    with many_partitions(spark):
        own = F.concat_ws(" ", F.lit("own"), "id")
        text = F.when(F.col("id") % 2 == 0, F.concat(F.lit("a\nb\nc\n"), own)).otherwise(F.concat_ws("\n", own, F.md5(own), F.lit("x"), own))
        docs = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("doc_id"), text.alias("text"))
        out = line_dedup.dedup_lines(docs)
        plan = executed(out)
        assert "skew=true" in plan
        assert out.agg(F.sum("n_removed")).first()[0] == 3 * 9_999


def test_a_payload(spark):
    with many_partitions(spark):
        page = F.when(F.col("id") % 2 == 0, F.lit("x" * 120)).otherwise(F.concat(F.lit("y" * 120), F.col("id")))
        pages = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), page.alias("html"))
        out = warc.with_verdicts(pages)
        assert "skew=true" in executed(out)
        assert out.where("refers_to = 0").count() == 9_999


def test_short_payloads_stay_apart(spark):
    """Empty pages are half of all: none of them goes through the join."""
    with many_partitions(spark):
        page = F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("y" * 120), F.col("id")))
        pages = spark.range(0, 2_000, 1, 8).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), page.alias("html"))
        out = warc.with_verdicts(pages)
        assert out.where("refers_to IS NULL").count() == 2_000


def _plans(monkeypatch, module) -> list[tuple[str, str]]:
    """The plans, as they ended, of all tables that a module writes from now on."""
    seen: list[tuple[str, str]] = []
    real = module.materialise

    def spy(df, label):
        seen.append((label, executed(df)))
        return real(df, label)

    monkeypatch.setattr(module, "materialise", spy)
    return seen


def _half_alike(spark, n: int, shared: str):
    """Every second text begins with one passage; all have words of their own."""
    own = F.concat_ws(" ", *(F.md5(F.concat("id", F.lit(i))) for i in range(12)))
    text = F.when(F.col("id") % 2 == 0, F.concat(F.lit(shared + " "), own)).otherwise(own)
    return spark.range(0, n, 1, 8).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))


def test_a_bucket_of_sets(spark, monkeypatch):
    """op1: sampled tokens that half of all sets hold."""
    with many_partitions(spark):
        plans = _plans(monkeypatch, jaccard_join)
        docs = _half_alike(spark, 1_600, " ".join(f"t{i}" for i in range(40)))
        found = jaccard_join.join_documents(docs, bucket_sets=100)
        assert found.where("n_links > 0").count() == 0
        assert any("skew=true" in plan for label, plan in plans if label in ("jaccard-candidates", "jaccard-large"))


def test_a_minimiser(spark, monkeypatch):
    """op3: a passage of half of all documents."""
    with many_partitions(spark):
        plans = _plans(monkeypatch, substring_dedup)
        docs = _half_alike(spark, 6_000, " ".join(f"t{i}" for i in range(60)))
        out = substring_dedup.dedup_substrings(docs)
        last = executed(out)
        assert out.where("n_removed = 60").count() == 3_000
        assert "skew=true" in last or any("skew=true" in plan for _, plan in plans)


def test_a_host_by_shuffle(spark, monkeypatch):
    """op8 with more lines above the limit than are sent to tasks: one host has most rows."""
    monkeypatch.setattr(quality_rules, "BROADCAST_LINES", 0)
    with many_partitions(spark):
        own = F.concat_ws(" ", *(F.md5(F.concat("id", F.lit(i))) for i in range(60)))
        docs = spark.range(0, 4_000, 1, 8).select(
            F.col("id").alias("doc_id"), F.concat(F.lit("the same head\n"), own).alias("text"), F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 64)).alias("source")
        )
        out = quality_rules.quality_verdicts(docs)
        assert "skew=true" in executed(out)
        assert out.where("kept AND n_boilerplate_words = 3").count() == 4_000
