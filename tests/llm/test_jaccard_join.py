from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import MEDIUM

from finloom.llm import jaccard_join
from finloom.llm.jaccard_join import SKETCH, join_documents, minima, runs_for
from finloom.operators.graph import components
from tests.llm.helpers import awkward, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ngrams(text) -> frozenset:
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows) -> list[tuple]:
    """class_id, n_copies and n_links of every row, by all pairs."""
    sets = [ngrams(r.text) for r in rows]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].add(i)
    linked = defaultdict(set)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g] if j != i)
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                linked[i].add(j)
    seen: dict[int, int] = {}
    for i in range(len(rows)):
        if i not in seen:
            todo, seen[i] = [i], i
            while todo:
                for j in linked[todo.pop()]:
                    if j not in seen:
                        seen[j] = i
                        todo.append(j)
    members = defaultdict(list)
    for i, root in seen.items():
        members[root].append(rows[i].doc_id)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    copies = Counter(sets)
    return [(low[seen[i]], copies[sets[i]] if sets[i] else 1, len(linked[i])) for i in range(len(rows))]


def _check(docs, **options):
    rows = docs.collect()
    expected = Counter((r.doc_id, *x) for r, x in zip(rows, brute(rows)))
    found = join_documents(docs, **options).collect()
    assert Counter((r.doc_id, r.class_id, r.n_copies, r.n_links) for r in found) == expected
    keepers = Counter(r.class_id for r in found if r.keeper and r.class_id is not None)
    assert set(keepers) == {r.class_id for r in found if r.class_id is not None}


def test_real_documents(spark):
    _check(spark.read.parquet(f"{MEDIUM}/documents.parquet"))


def test_awkward(spark):
    _check(awkward(spark))


def test_empty(spark):
    assert join_documents(documents(spark, [])).count() == 0


def _near_copies(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    base = [f"b{seed}w{i}" for i in range(300)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(8)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out


def test_groups_of_near_copies(spark):
    _check(documents(spark, _near_copies(40, 1) + _near_copies(3, 2) + _near_copies(2, 3)))


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 101), (102, 101), (7, 7)]
    found = {r.vertex: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 51)}, 101: 100, 102: 100}


def test_runs_reach_the_recall():
    for recall in (0.9, 0.99, 0.9999):
        runs = runs_for(recall, 0.8)
        assert 1 - 0.2**runs >= recall > 1 - 0.2 ** (runs - 1)


def _hot_texts() -> list[str]:
    """Two groups of near copies, one of them and others with a passage in common, and some copies."""
    passage = " ".join(f"p{i}" for i in range(150))
    near = _near_copies(40, 1)
    return near + near[:5] + [f"{passage} {t}" for t in _near_copies(30, 3)] + [f"{passage} own{i} own" for i in range(20)]


@pytest.mark.parametrize("small, block", [(4, 8), (4, 1024), (256, 2048)])
def test_large_buckets_count_all_links(spark, monkeypatch, small, block):
    """Every link within groups far over the limits, in tasks and before them."""
    monkeypatch.setattr(jaccard_join, "SMALL_SETS", small)
    monkeypatch.setattr(jaccard_join, "TINY", 3)
    monkeypatch.setattr(jaccard_join, "COUNT_SETS", block)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 50)
    _check(documents(spark, _hot_texts()), bucket_sets=12)


def test_equal_results_at_every_bucket_size(spark):
    docs = documents(spark, _hot_texts())
    found = [sorted(join_documents(docs, bucket_sets=n).collect()) for n in (6, 30, 10_000)]
    assert found[0] == found[1] == found[2]


def test_shared_ngrams(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200), np.uint64)) for _ in range(30)]
    for dense, columns in ((0.0, 7), (0.3, 64), (2.0, 64)):
        monkeypatch.setattr(jaccard_join, "DENSE", dense)
        monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
        shared, across = jaccard_join.shared_ngrams(sets), jaccard_join.shared_ngrams(sets[:11], sets[11:])
        for i, j in combinations(range(30), 2):
            n = len(np.intersect1d(sets[i], sets[j]))
            assert shared[i, j] == n
            assert not (i < 11 <= j) or across[i, j - 11] == n


def test_recall_where_buckets_split(monkeypatch):
    """One bucket with a thousand pairs at 0.8 among sets that share a passage: a
    run keeps the stated share of the pairs, and seven runs reach the target."""
    monkeypatch.setattr(jaccard_join, "SMALL_SETS", 16)
    rng = np.random.default_rng(11)
    shared = rng.integers(1, 1 << 60, 30, np.uint64)
    sets = []
    for _ in range(1000):
        own = rng.integers(1, 1 << 60, 90, np.uint64)
        sets += [np.unique(np.concatenate([shared[:15], own[:85]])), np.unique(np.concatenate([shared[:15], own[:74], rng.integers(1, 1 << 60, 11, np.uint64)]))]
    sizes = np.array([len(x) for x in sets])
    alike = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(sets[::2], sets[1::2])]
    assert 0.79 < min(alike) <= max(alike) < 0.81
    low = minima(sets, SKETCH)
    sketches = ((low ^ (low >> np.uint64(29))) * jaccard_join._ODD >> np.uint64(56)).astype(np.uint8)
    met = []
    for run in range(7):
        group = jaccard_join.candidate_groups(run * 7919, sketches, sizes, 0.8)
        met.append(np.array([group[i] == group[i + 1] for i in range(0, 2000, 2)]))
    # The estimate itself misses next to none of these pairs.
    assert np.mean(met) >= jaccard_join.kept_together(0.8) - 0.03
    assert np.mean(np.any(met, axis=0)) >= 0.999


def test_runs_allow_for_splits():
    share = 0.8 * jaccard_join.kept_together(0.8)
    assert abs(share - 0.75) < 1e-9
    assert runs_for(0.9999, share) == 7


def test_filter_of_holders(spark, monkeypatch):
    """Every holder passes, whatever the size of the filter; with room few others do."""
    rows = spark.range(4_000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("row_hash"), F.lit("t").alias("text"))
    holders = rows.where("doc_id % 40 = 0")
    for bits, most in ((1 << 26, 105), (1 << 10, 4_000), (8, 4_000)):
        monkeypatch.setattr(jaccard_join, "FILTER_BITS", bits)
        found = {r.doc_id for r in jaccard_join._could_hold(rows, holders).collect()}
        assert {i for i in range(0, 4_000, 40)} <= found and len(found) <= most
    assert jaccard_join._could_hold(rows, holders.limit(0)).count() == 0
