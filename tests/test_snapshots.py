from __future__ import annotations

import json
import os
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finloom import snapshots
from finloom.snapshots import Manifests, SnapshotWriter, commit, read_snapshot, upsert_snapshot, upsert_stream
from finloom.streaming import incremental

SCHEMA = "k long, v string, at int"


def rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def _data_files(path) -> set[str]:
    return {f"data/{x}" for x in os.listdir(f"{path}/data")}


def test_upserts(spark, tmp_path):
    """Versions stay readable; the last change of a key counts; null keys are left out."""
    path = str(tmp_path / "t")
    assert read_snapshot(spark, path) is None
    assert upsert_snapshot(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "c", 2), (None, "x", 1)], SCHEMA), path, "k", "at") == 1
    assert upsert_snapshot(spark.createDataFrame([(2, "d", 3), (3, None, 3)], SCHEMA), path, "k", "at") == 2
    assert rows(read_snapshot(spark, path)) == Counter([(1, "a", 1), (2, "d", 3), (3, None, 3)])
    assert rows(read_snapshot(spark, path, 1)) == Counter([(1, "a", 1), (2, "c", 2)])
    assert upsert_snapshot(spark.createDataFrame([], SCHEMA), path, "k") == 3
    assert read_snapshot(spark, path).count() == 3 and Manifests(path).newest()["rows"] == 3
    empty = str(tmp_path / "e")
    upsert_snapshot(spark.createDataFrame([], SCHEMA), empty, "k")
    assert read_snapshot(spark, empty).count() == 0


def test_two_writers(spark, tmp_path):
    """The second of two commits starts again from the first one's version; its files of
    the lost attempt are gone."""
    path = str(tmp_path / "t")
    upsert_snapshot(spark.createDataFrame([(1, "a", 1)], SCHEMA), path, "k")
    seen = []

    def build(old):
        seen.append(old.count())
        if len(seen) == 1:  # while this one is at work, another commits
            upsert_snapshot(spark.createDataFrame([(2, "other", 1)], SCHEMA), path, "k")
        return old.unionByName(spark.createDataFrame([(3, "own", 1)], SCHEMA))

    assert commit(spark, path, build) == 3 and seen == [1, 2]
    assert rows(read_snapshot(spark, path)) == Counter([(1, "a", 1), (2, "other", 1), (3, "own", 1)])
    named = {f for v in (1, 2, 3) for f in Manifests(path).read(v)["files"]}
    assert named == _data_files(path)


def test_an_endless_conflict_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "ATTEMPTS", 2)
    path = str(tmp_path / "t")

    def build(old):
        upsert_snapshot(spark.createDataFrame([(1 if old is None else old.count() + 1, "x", 1)], SCHEMA), path, "k")
        return spark.createDataFrame([(9, "own", 1)], SCHEMA)

    with pytest.raises(Exception, match="another writer"):
        commit(spark, path, build)
    assert rows(read_snapshot(spark, path)) == Counter([(1, "x", 1), (2, "x", 1)])


def test_attempts(tmp_path):
    """Attempts that failed or came twice are in no version; an aborted job leaves nothing."""
    path = str(tmp_path / "t")
    schema = StructType.fromJson(json.loads('{"type":"struct","fields":[{"name":"k","type":"long","nullable":true,"metadata":{}}]}'))
    batch = pa.RecordBatch.from_pydict({"k": [1, 2]})

    def failing():
        yield batch
        raise ValueError("executor lost")

    writer = SnapshotWriter({"path": path, "base": "0"}, schema, True)
    with pytest.raises(ValueError):
        writer.write(failing())
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch, batch]))
    writer.commit([kept, None, writer.write(iter([]))])
    assert Manifests(path).newest()["files"] == kept.files and Manifests(path).newest()["rows"] == 4
    assert set(lost.files).isdisjoint(kept.files)
    other = SnapshotWriter({"path": path, "base": "1"}, schema, False)
    more = other.write(iter([batch]))
    other.abort([more, None])
    assert Manifests(path).newest()["version"] == 1 and not set(more.files) & _data_files(path)
    late = SnapshotWriter({"path": path, "base": "0"}, schema, True)
    message = late.write(iter([batch]))
    with pytest.raises(RuntimeError, match="another writer"):
        late.commit([message])
    assert not set(message.files) & _data_files(path) and set(kept.files) <= _data_files(path)


def test_a_failing_job_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_snapshot(spark.createDataFrame([(1, "a", 1)], SCHEMA), path, "k")
    bad = F.when(F.col("k") == 7, F.raise_error(F.lit("stop"))).otherwise("v")
    with pytest.raises(Exception, match="stop"):
        commit(spark, path, lambda old: spark.range(20).select(F.col("id").alias("k"), F.lit("v").alias("v"), F.lit(1).alias("at")).withColumn("v", bad))
    assert Manifests(path).newest()["version"] == 1 and rows(read_snapshot(spark, path)) == Counter([(1, "a", 1)])


def test_a_stream_and_a_replayed_batch(spark, tmp_path):
    path, source = str(tmp_path / "t"), tmp_path / "in"
    for i in range(3):
        spark.createDataFrame([(i, f"v{i}", i), (9, f"v{i}", i)], SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
    stream = incremental.stream_of(spark, str(source), SCHEMA)

    def run(checkpoint):
        upsert_stream(stream, path, "k", checkpoint, "w", "at").trigger(availableNow=True).start().awaitTermination()

    run(str(tmp_path / "c1"))
    assert Manifests(path).newest()["version"] == 3
    found = rows(read_snapshot(spark, path).select("k"))
    assert found == Counter([(0,), (1,), (2,), (9,)])
    run(str(tmp_path / "c2"))  # all batches again, as after a lost checkpoint
    assert Manifests(path).newest()["version"] == 3 and rows(read_snapshot(spark, path).select("k")) == found
    assert upsert_snapshot(spark.createDataFrame([(5, "new", 1)], SCHEMA), path, "k", writer="w", batch=3) == 4
