"""Tables written once to the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse
from weakref import WeakKeyDictionary

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Folder of every table that ``materialise`` returned and that is still in use.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Folders of this process's sessions that haven't been deleted, in order.
_WRITTEN: dict[str, None] = {}


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store that holds ``uri`` and the path in it (a plain path is local)."""
    if not urlparse(uri).scheme:
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Only a session of one local process (as in tests) may lack that setting; it
    gets a folder of the local machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = "file://" + tempfile.gettempdir() + "/checkpoints"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a copy that survives the loss of executors, and
    makes several consumers share one computation.  ``discard`` deletes the copy
    when no consumer is left, ``release`` what remains of all.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    _WRITTEN[path] = None
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def materialise_dealt(df: DataFrame, label: str, key: str, parts: int) -> DataFrame:
    """``materialise`` in ``parts`` buckets of ``key``: groups and windows that begin
    with it, over what is read from the table, need no shuffle."""
    spark = df.sparkSession
    path, name = shared_dir(spark, label), f"{label}_{uuid.uuid4().hex}"
    _WRITTEN[path] = None
    df.repartition(parts, key).write.option("compression", "zstd").option("path", path).bucketBy(parts, key).saveAsTable(name)
    table = spark.table(name).toDF(*df.columns)  # columns that bear the table's name lose the buckets in a union
    spark.sql(f"DROP TABLE {name}")  # the name alone; the files stay
    _FOLDERS[table] = path
    return table


def folder(table: DataFrame) -> str:
    """Where ``materialise`` wrote a table, for tasks that read its files themselves."""
    return _FOLDERS[table]


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` returned, when all that was read from
    them is written."""
    for table in tables:
        if path := _FOLDERS.pop(table, None):
            _delete(table.sparkSession, path)


def hand_over(table: DataFrame, derived: DataFrame) -> DataFrame:
    """``derived``, which ``discard`` then takes for ``table``."""
    if path := _FOLDERS.get(table):
        _FOLDERS[derived] = path
    return derived


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Delete at the end all tables that were written meanwhile but those that
    were put into the list."""
    before = set(_WRITTEN)
    kept: list[DataFrame] = []
    yield kept
    folders = {_FOLDERS.get(table) for table in kept}
    for path in list(_WRITTEN):
        if path not in before and path not in folders:
            _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete all tables that ``materialise`` wrote in this process: for use when
    the results that were built on them are written."""
    for path in list(_WRITTEN):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    _WRITTEN.pop(path, None)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly.  A join needs an exchange of its own after it, which is
    what adaptive execution can split at a hot key; an aggregation or another
    join right before it would leave the join without one.  For small tables
    that join big ones."""
    return df.hint("rebalance")
