"""The stages against brute-force versions, one after another."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from tests.conftest import SMALL

from finloom.storage import materialise
from tests.llm import test_jaccard_join, test_line_dedup, test_quality_rules
from tests.llm.helpers import awkward, documents


def _bag(rows) -> Counter:
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows)


def _stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SMALL), "test-stage")
        out.append(docs)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    quality, lines, near, mixed, encoded = _stages(spark, docs)
    rows = docs.collect()
    kept = [r for r, verdict in zip(rows, test_quality_rules.brute(rows)) if verdict[-1]]
    assert _bag(quality.collect()) == _bag(kept)

    text = F.coalesce("text", F.lit(""))
    hashed = [tuple(r) for r in quality.select("doc_id", F.xxhash64(text, F.length(text)), text).collect()]
    assert Counter((r.doc_id, r.text, r.n_chars) for r in lines.collect()) == Counter((i, t, len(t)) for i, _, _, t in test_line_dedup.brute(hashed))

    left = lines.collect()
    classes = test_jaccard_join.brute(left)
    assert Counter(r.doc_id for r in near.collect()) == Counter({c[0]: 1 for c in classes})
    assert set(_bag(near.collect())) <= set(_bag(left))

    once = _bag(near.collect())
    taken = _bag(mixed.collect())
    assert set(taken) <= set(once) and all(n <= 2 * once[k] for k, n in taken.items())

    digests = {hashlib.sha256((r.text or "").encode()).hexdigest() for r in mixed.collect()}
    ids = encoded.collect()
    assert Counter(r.doc_id for r in ids) == Counter(r.doc_id for r in mixed.collect())
    assert {r.decoded_sha256 for r in ids} == digests
    assert all(len(r.ids) == 4 * r.n_tokens for r in ids)


def test_columns_and_awkward_rows(spark):
    docs = awkward(spark)
    for out in _stages(spark, docs)[:-1]:
        assert out.columns == docs.columns
    long = documents(spark, [" ".join(f"a{i}" for i in range(80))] * 3, ids=[1, 1, 2])
    near = _stages(spark, long)[2]
    assert [r.doc_id for r in near.collect()] == [1]


def test_empty(spark):
    assert [x.count() for x in _stages(spark, documents(spark, []))] == [0] * 5
