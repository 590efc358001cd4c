from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from tests.conftest import MEDIUM

from finloom.llm import substring_dedup
from finloom.llm.substring_dedup import dedup_substrings, hash_texts, super_kmers
from tests.llm.helpers import awkward, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts: list, window: int) -> list[tuple[int, int, str]]:
    words = [WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def _results(df) -> list:
    return sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect())


def _check(docs, window=35):
    rows = docs.collect()
    expected = sorted((r.doc_id is None, r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows], window)))
    assert _results(dedup_substrings(docs, window)) == expected


def test_real_documents(spark):
    _check(spark.read.parquet(f"{MEDIUM}/documents.parquet"))


def test_awkward(spark):
    _check(awkward(spark))


def test_empty(spark):
    assert dedup_substrings(documents(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [1000, 2])
def test_shared_passages_and_hot_buckets(spark, monkeypatch, limit):
    """The spread-out way for hot buckets gives the same words."""
    monkeypatch.setattr(substring_dedup, "BUCKET_STRINGS", limit)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(300)}"
    passage = [word() for _ in range(50)]
    texts = []
    for _ in range(60):
        own = [word() for _ in range(rng.randrange(0, 120))]
        at = rng.randrange(len(own) + 1)
        texts.append(" ".join(own[:at] + passage[rng.randrange(10) :] * rng.randrange(3) + own[at:]))
    texts += ["x " * 200, "y z " * 30, "u " * 40, texts[0], texts[0]]
    _check(documents(spark, texts))


def test_super_kmers_hold_every_window_once():
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(4)}".encode() for _ in range(n)] for n in (0, 5, 35, 36, 400)]
    text, _, start, count, _ = super_kmers(*hash_texts([b" ".join(x) for x in texts]))
    found = sorted((t, s + i) for t, s, n in zip(text.tolist(), start.tolist(), count.tolist()) for i in range(n))
    assert found == [(t, i) for t, w in enumerate(texts) for i in range(len(w) - 34)]


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_hashes_of_texts_are_those_of_their_words(monkeypatch, block):
    """However texts are put together, and for words of every length."""
    monkeypatch.setattr(substring_dedup, "HASHED_BYTES", block)
    rng = random.Random(block)
    for _ in range(100):
        texts = [bytes(rng.choice(b" \t\n\x0b\x0c\r ab\xc3\xa9c") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(8))]
        texts += [b"x" * rng.choice([0, 255, 256, 257, 900]) + b" y"]
        hashes, counts = hash_texts(texts)
        words = [x.split() for x in texts]
        assert counts.tolist() == [len(x) for x in words]
        assert hashes.tolist() == [substring_dedup._hash_word(w) for x in words for w in x]
    assert [len(x) for x in hash_texts([])] == [0, 0]
