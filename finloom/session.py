"""The session that the examples, tests and benchmark use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "finloom", master: str | None = None, checkpoint_dir: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides by key with
    dots written as double underscores.  ``checkpoint_dir`` is the folder that all
    executors share; the cluster's own setting stays if it is None."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
