from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.conftest import SMALL

from finloom.llm import importance
from finloom.llm.importance import BUCKETS, resample, text_features
from tests.llm.helpers import awkward, documents, executed, many_partitions

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: str | None) -> list[str]:
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def buckets(text: str | None) -> list[int]:
    return [zlib.crc32(f.encode()) % BUCKETS for f in features(text)]


def brute(docs: list[tuple], target: list) -> list[tuple]:
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    S, T = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0)))) for b in range(BUCKETS)}
    rows = []
    for doc_id, text in docs:
        b = buckets(text)
        weight = math.floor(sum(map(gain.get, b)) / len(b)) if b else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in rows if r[1] >= 39), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for place, r in enumerate(may[: 25 * len(may) // 100], 1):
        r[4] = place
    return [tuple(r) for r in rows]


def check(spark, docs, target: list):
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    found = Counter(tuple(r) for r in resample(docs, bench).collect())
    assert found == Counter(brute([(r.doc_id, r.text) for r in docs.collect()], target))
    return found


PIECES = st.lists(st.sampled_from(["The", "a", "x" * 47, "y" * 48, "z" * 49, "日本語" * 20, "-", "\n", "ab-C", "i'm", "İ"]), max_size=50).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=8), st.sampled_from([1, 40, 300, 1 << 18]))
def test_features(texts, size):
    before, importance.HASHED_BYTES = importance.HASHED_BYTES, size
    try:
        found = text_features([x.encode() for x in texts])
    finally:
        importance.HASHED_BYTES = before
    assert [sorted(x.tolist()) for x in found] == [sorted(buckets(x)) for x in texts]


def test_given(spark):
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = check(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), target)
    assert sum(r[4] is not None for r in found) > 20


def test_awkward(spark):
    """Null, empty and repeated texts, a null id, ids that repeat with equal texts, one very long text."""
    more = documents(spark, [" ".join(f"k{i * j % 97}" for j in range(30)) for i in range(40)] + ["tie " * 25] * 20, ids=[*range(100, 140), *[9] * 20])
    check(spark, awkward(spark).unionByName(more), ["same1 same2", None, "", "k1 k2 tie tie tie"])


def test_nothing_given(spark):
    assert check(spark, documents(spark, []), ["a b"]) == Counter()
    check(spark, awkward(spark), [])


def test_a_text_that_most_documents_are(spark):
    """Copies are one row a task before the shuffle, and their weights come back in split joins."""
    with many_partitions(spark):
        text = F.when(F.col("id") % 2 == 0, F.lit("the same words " * 10)).otherwise(F.concat_ws(" ", *(F.md5(F.concat("id", F.lit(j))) for j in range(25))))
        docs = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("doc_id"), text.alias("text"))
        bench = docs.limit(10)
        plans = []
        real = importance.materialise

        def spy(df, label):
            if label == "importance-scores":
                plans.append(executed(df))
            return real(df, label)

        importance.materialise = spy
        try:
            found = resample(docs, bench)
            assert found.where("rank IS NOT NULL").count() == 5_000
        finally:
            importance.materialise = real
        assert "skew=true" in plans[0]
