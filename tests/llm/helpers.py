"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Extra columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_hash string, key string, n int"


def documents(spark: SparkSession, texts: list, sources: list | None = None, ids: list | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, len(t or ""), "x", None, 7) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    """Null and empty texts, a null id and source, white space, repeats and one very long text."""
    long = " ".join(f"w{i % 5000}" for i in range(20_000))
    same = " ".join(f"same{i}" for i in range(60))
    texts = [None, "", " \n\t", "one", same, same, same, long, "naïve   café 日本 語", "a\nb\nc\na\nb\nc", same]
    ids = [0, 1, 2, 3, 4, 4, 5, 6, 7, 8, None]
    sources = ["a", None, "a", "b", "a", "a", None, "b", "a", "a", "b"]
    return documents(spark, texts, sources, ids)


@contextmanager
def many_partitions(spark: SparkSession) -> Iterator[None]:
    """Settings under which a key of a tenth of the rows is a skewed partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.files.maxPartitionBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def executed(df: DataFrame) -> str:
    """The plan that adaptive execution ended with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
