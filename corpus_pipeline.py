"""A training-data pipeline made of the operators of ``finloom.llm``.

Every stage reads what its predecessor kept and wrote.  All but the last return
the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm import bpe, jaccard_join, line_dedup, quality_rules, source_mix
from finloom.llm.common import text_column, text_hash
from finloom.storage import discard, materialise, temporary


def _with_verdicts(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` joined with the verdicts on their (doc_id, row_hash)."""
    named = docs.withColumn("row_hash", text_hash(text_column())).alias("d")
    # Rows that repeat one id and text have equal verdicts: one of them is enough.
    kept = verdicts.distinct().alias("v")
    same = F.col("d.doc_id").eqNullSafe(F.col("v.doc_id")) & (F.col("d.row_hash") == F.col("v.row_hash"))
    return named.join(kept, same)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their boilerplate lines."""
    kept = quality_rules.quality_verdicts(docs, columns=tuple(docs.columns)).where("kept")
    cut = F.col("n_boilerplate_words") > 0
    new = {
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return kept.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of later repeats of three-line windows."""
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return line_dedup.dedup_lines(docs).select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    kept = jaccard_join.join_documents(docs).where("keeper").select("doc_id", "row_hash")
    return _with_verdicts(docs, kept).select("d.*").dropDuplicates(["doc_id", "row_hash"]).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    taken = source_mix.mix_sources(docs).where("copies > 0").groupBy("doc_id", "row_hash").agg(F.sum("copies").alias("copies"))
    once = _with_verdicts(docs, taken).select("d.*", "copies").dropDuplicates(["doc_id", "row_hash"])
    return once.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, unsigned 32-bit little-endian, and their digest."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("byte-level BPE encoding and decoding", encoding),
]
#: Mixing draws at random and the join samples tokens; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # What a stage writes for itself goes when its result is written.
        with temporary(spark) as kept:
            kept.append(materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-")))
        discard(docs)
        docs = kept[0]
    return STAGES[-1][1](spark, docs, sf_dir)
