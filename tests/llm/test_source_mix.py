from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from tests.conftest import MEDIUM

from finloom.llm import source_mix
from finloom.llm.source_mix import mix_sources
from tests.llm.helpers import awkward, documents


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2) -> dict:
    """Water filling by definition: share, cut, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out = dict.fromkeys(sizes, 0.0)
    left = share * sum(sizes.values())
    free = set(sizes)
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            out[s] += left * weight[s] / total
        left = sum(max(0, out[s] - most * sizes[s]) for s in free)
        full = {s for s in free if out[s] >= most * sizes[s]}
        for s in full:
            out[s] = float(most * sizes[s])
        free -= full
    return out


def _check(docs, near):
    rows = mix_sources(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        assert 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    expected = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= (largest[s] if near else 2 * largest[s])
    return sorted((tuple(r) for r in rows), key=str)


def test_real_documents_and_reruns(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    assert _check(docs, near=True) == _check(docs.repartition(7), near=True)


def test_awkward(spark):
    _check(awkward(spark), near=True)


def test_empty(spark):
    assert mix_sources(documents(spark, [])).count() == 0


def test_a_source_of_many_blocks(spark):
    """Several levels of the tree; the expectation holds over the documents."""
    docs = documents(spark, ["w " * (1 + i % 9) for i in range(3000)], ["big" if i % 3 else "small" for i in range(3000)])
    rows = _check(docs, near=True)
    assert {r[0] for r in rows} == {"big", "small"}


def test_rows_of_one_id_and_text(spark, monkeypatch):
    """Half of the rows repeat one id and text; they are rounded apart from each other."""
    monkeypatch.setattr(source_mix, "REPEATS", 100)
    texts = ["w " * 7] * 1001 + ["w " * (1 + i % 9) for i in range(1000)]
    docs = documents(spark, texts, ["a"] * 1500 + ["b"] * 501, [1] * 1001 + list(range(2, 1002)))
    rows = _check(docs, near=True)
    assert sum(r[1] == 1 for r in rows) == 1001
    assert len({r[-1] for r in rows if r[1] == 1}) == 2
