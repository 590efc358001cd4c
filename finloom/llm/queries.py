"""The operators of this subpackage bound to the driver's tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm import (
    bpe,
    decontamination,
    importance,
    jaccard_join,
    license_scan,
    line_dedup,
    media,
    merkle,
    quality_rules,
    secret_scan,
    source_mix,
    substring_dedup,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_copies", "n_links", "keeper"
    )


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = media.write_archives(_table(spark, sf_dir, "documents"))
    return media.media_features(media.read_archives(spark, manifest))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(_table(spark, sf_dir, "pages"))
    return warc.read_warc(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    each = "concat_ws(':', x.license, x.start, x.end, x.matched, x.words)"
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("licenses"),
        F.expr(f"concat_ws(',', transform(licenses, x -> {each}))").alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(_table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_boilerplate_words", F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    base = [k for k in secret_scan.KINDS[:3]]
    joined = "concat_ws(',', transform({}, x -> concat_ws(':', x.kind, x.start, x.end)))"
    of_base = "filter(secrets, x -> x.kind IN ('assign', 'access', 'hex'))"
    return found.select(
        "doc_id",
        *(F.expr(f"size(filter(secrets, x -> x.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in base),
        F.sha2(F.expr(joined.format(of_base)), 256).alias("base_sha256"),
        F.expr(joined.format("secrets")).alias("spans"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = merkle.leaf_digest(*(lower if f == "text" else F.col(f) for f in merkle.FIELDS))
    found = merkle.manifest(_table(spark, sf_dir, "documents"), carried={"changed": F.when(tampered, changed)})
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        *(merkle.shown(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
        merkle.shown(folded).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    found = (
        op1_jaccard_join,
        op2_media_columns,
        op3_substring_dedup,
        op4_warc,
        op5_line_dedup,
        op6_bpe,
        op7_license_scan,
        op8_quality_rules,
        op9_source_mix,
        op10_secret_scan,
        op11_merkle_manifest,
        op12_decontamination,
        op13_importance_resampling,
    )
    import corpus_pipeline

    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}
