"""Tables that change by commits: data files and a manifest for every version.

A write leaves files of its own for every attempt of a task.  They become part
of the table when the driver publishes the manifest of the next version, which
names the files of the successful attempts; readers take the newest manifest.
Two writers of one version can't both publish it: the one that comes second
starts again from the version it lost to.  What a batch of a stream has written
is in the manifest, so a replayed batch changes nothing.

Manifests are published by making a name that must not exist yet: a hard link on
local disks, elsewhere a rename, which the store has to refuse if the name exists.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as papq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from finloom.storage import materialise, store_of

#: Rows of a file, and times that a write starts again after another one's commit.
FILE_ROWS, ATTEMPTS = 1_000_000, 10
CONFLICT = "another writer committed version"


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


class Manifests:
    """The versions of the table in a folder."""

    def __init__(self, path: str):
        self.fs, self.place = store_of(path)
        self.folder = f"{self.place.rstrip('/')}/versions"

    def newest(self) -> dict:
        """The newest manifest; version 0 of a table that isn't there yet."""
        found = self.fs.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True))
        names = [f.base_name for f in found if f.base_name.endswith(".json")]
        return self.read(int(max(names).partition(".")[0])) if names else {"version": 0, "files": [], "schema": None, "batches": {}, "rows": 0}

    def read(self, version: int) -> dict:
        with self.fs.open_input_stream(f"{self.folder}/{version:020d}.json") as source:
            return json.loads(source.read())

    def publish(self, manifest: dict) -> None:
        """Make a version, or raise if it exists."""
        name = f"{self.folder}/{manifest['version']:020d}.json"
        own = f"{self.folder}/.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.folder, recursive=True)
        with self.fs.open_output_stream(own) as out:
            out.write(json.dumps(manifest).encode())
        try:
            if isinstance(self.fs, pafs.LocalFileSystem):
                os.link(own, name)
            elif self.fs.get_file_info(name).type != pafs.FileType.NotFound:
                raise FileExistsError(name)
            else:
                self.fs.move(own, name)
                return
        except FileExistsError:
            raise RuntimeError(f"{CONFLICT} {manifest['version']}") from None
        finally:
            if self.fs.get_file_info(own).type != pafs.FileType.NotFound:
                self.fs.delete_file(own)


class SnapshotWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        self.path, self.base = options["path"], int(options["base"])
        self.writer, self.batch = options.get("writer"), int(options.get("batch", -1))
        self.schema, self.overwrite = schema.json(), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Files of this attempt; no other attempt uses their names."""
        fs, place = store_of(self.path)
        fs.create_dir(f"{place}/data", recursive=True)
        files, rows, out, held = [], 0, None, 0
        try:
            for batch in iterator:
                if out is None or held >= FILE_ROWS:
                    if out:
                        out.close()
                    files.append(f"data/{uuid.uuid4().hex}.parquet")
                    out, held = papq.ParquetWriter(f"{place}/{files[-1]}", batch.schema, filesystem=fs, compression="zstd"), 0
                out.write_batch(batch)
                held += batch.num_rows
                rows += batch.num_rows
        finally:
            if out:
                out.close()
        return Written(files, rows)

    def commit(self, messages: list[Written | None]) -> None:
        manifests = Manifests(self.path)
        old = manifests.read(self.base) if self.base else {"files": [], "batches": {}, "rows": 0}
        done = [m for m in messages if m is not None]
        kept, n = ([], 0) if self.overwrite else (old["files"], old["rows"])
        batches = old["batches"] | ({self.writer: self.batch} if self.writer else {})
        files = kept + [f for m in done for f in m.files]
        try:
            manifests.publish({"version": self.base + 1, "files": files, "schema": self.schema, "batches": batches, "rows": n + sum(m.rows for m in done)})
        except RuntimeError:
            self.abort(messages)
            raise

    def abort(self, messages: list[Written | None]) -> None:
        """Delete what successful attempts wrote; what failed ones left is in no manifest."""
        fs, place = store_of(self.path)
        for message in messages:
            for name in message.files if message is not None else ():
                if fs.get_file_info(f"{place}/{name}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{place}/{name}")


class SnapshotSource(DataSource):
    """``df.write.format("snapshot_table").option("base", version)``: rows are appended to
    the table, or replace it (mode overwrite), as version base + 1."""

    @classmethod
    def name(cls) -> str:
        return "snapshot_table"

    def writer(self, schema: StructType, overwrite: bool) -> SnapshotWriter:
        return SnapshotWriter(dict(self.options), schema, overwrite)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The table as of a version (the newest if None); None if there is none."""
    manifests = Manifests(path)
    found = manifests.newest() if version is None else manifests.read(version)
    return _table(spark, path, found)


def _table(spark: SparkSession, path: str, manifest: dict) -> DataFrame | None:
    if manifest["schema"] is None:
        return None
    schema = StructType.fromJson(json.loads(manifest["schema"]))
    if not manifest["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path.rstrip('/')}/{f}" for f in manifest["files"]))


def commit(spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame], overwrite: bool = True, writer: str | None = None, batch: int = -1) -> int:
    """Publish the rows ``build`` makes of the current table (None: no table yet) as the next
    version and return it.  If another writer was faster, ``build`` starts again from
    what that one published.  A ``batch`` of ``writer`` that is committed already (or
    is older than one) changes nothing.
    """
    spark.dataSource.register(SnapshotSource)
    for attempt in range(ATTEMPTS):
        old = Manifests(path).newest()
        if writer is not None and old["batches"].get(writer, -1) >= batch:
            return old["version"]
        out = build(_table(spark, path, old)).write.format("snapshot_table").option("path", path).option("base", old["version"])
        if writer is not None:
            out = out.option("writer", writer).option("batch", batch)
        try:
            out.mode("overwrite" if overwrite else "append").save()
            return old["version"] + 1
        except Exception as e:
            if CONFLICT not in str(e) or attempt == ATTEMPTS - 1:
                raise
    raise AssertionError("unreachable")


def upsert_snapshot(changes: DataFrame, path: str, key: str, order: str | None = None, writer: str | None = None, batch: int = -1) -> int:
    """Rows of ``changes`` replace those with their key, as one commit; of several changes
    of a key the last by ``order`` counts (any, without it).  Rows with a null key
    are left out.  Columns must be those of the table.
    """
    spark = changes.sparkSession
    columns = changes.columns
    row = F.struct(*columns)
    last = F.max_by(row, F.struct(order, F.xxhash64(*columns))) if order else F.max_by(row, F.xxhash64(*columns))
    # Written once: a commit that starts again doesn't compute the changes again.
    once = materialise(changes.where(F.col(key).isNotNull()).groupBy(key).agg(last.alias("r")).select("r.*"), "upsert-changes")

    def build(old: DataFrame | None) -> DataFrame:
        if old is None:
            return once
        return old.select(*columns).join(once.select(key), key, "left_anti").select(*columns).unionByName(once)

    return commit(spark, path, build, writer=writer, batch=batch)


def upsert_stream(stream: DataFrame, path: str, key: str, checkpoint: str, writer: str, order: str | None = None):
    """Upsert every batch of a stream once, however often it is replayed; returns the query's writer."""
    each = lambda rows, batch: upsert_snapshot(rows, path, key, order, writer, batch)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode("update")
