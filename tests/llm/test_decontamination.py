from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finloom.llm import ascii_words, decontamination
from finloom.llm.decontamination import Matcher, contamination
from tests.llm.helpers import awkward, documents

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(text: str | None) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()


def brute(text: str | None, items: list[tuple]) -> tuple[int, set[int], list[str]]:
    w = words(text)
    places: dict[tuple, list[int]] = {}
    for n in {len(x) for _, t in items for x in windows(t)}:
        for i in range(len(w) - n + 1):
            places.setdefault(tuple(w[i : i + n]), []).append(i)
    hit, found = set(), set()
    for item, t in items:
        for x in windows(t):
            for i in places.get(x, ()):
                hit |= set(range(i, i + len(x)))
                if item is not None:
                    found.add(str(item))
    return len(w), hit, sorted(found)


TEXTS = st.lists(st.sampled_from(["a", "B", "ab", "é", "x1", "İ", ",", "-", "\n", "日本"]), max_size=60).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.lists(TEXTS, max_size=4), st.sampled_from([1, 7, 1 << 20]))
def test_scan(text, items, size):
    items = list(enumerate(items))
    table: dict[tuple, list[str]] = {}
    for item, t in items:
        for x in windows(t):
            table.setdefault(x, []).append(str(item))
    matcher = Matcher([(" ".join(x).encode(), ids) for x, ids in table.items()], 10)
    defaults = ascii_words.overlapping.__defaults__
    ascii_words.overlapping.__defaults__ = (size,)
    try:
        n, spans, found = matcher.scan(text.encode())
    finally:
        ascii_words.overlapping.__defaults__ = defaults
    if not items:
        assert (spans, found) == ([], [])
        return
    expected = brute(text, items)
    assert (n, {i for a, b in spans for i in range(a, b)}, found) == expected
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def _check(spark, docs, items, block_pairs):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, row_hash string")
    rows = contamination(docs, bench, columns=("doc_id", "text"), block_pairs=block_pairs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, hit, found = brute(r.row.text, items)
        assert (r.n_words, {i for s in r.spans for i in range(s.start, s.end)}, r.items) == (n, hit, found)
    return rows


@pytest.mark.parametrize("block_pairs", [100_000, 5])
def test_awkward(spark, block_pairs):
    """Short items, an item that a document repeats, a null id, one block of windows and many."""
    same = " ".join(f"same{i}" for i in range(60))
    long = " ".join(f"w{i % 5000}" for i in range(4000, 4040))
    items = [(1, same), (2, "One"), (3, None), (4, " , "), (None, long), (5, "naïve CAFÉ"), (1, "日本"), (7, long), (8, "b c\nA b")]
    rows = _check(spark, awkward(spark), items, block_pairs)
    assert any(len(r["items"]) == 1 and len(r.spans) == 4 for r in rows)


@pytest.mark.parametrize("block_pairs", [100_000, 200])
def test_passages(spark, block_pairs):
    """Passages of many items in many documents, across the pieces of a long text."""
    bench = [(i, " ".join(f"t{(i * 37 + j * j) % 251}" for j in range(30 + i))) for i in range(20)]
    texts = [" ".join(["lead"] * i + bench[i % 20][1].split()[i % 7 : 25] + ["tail"] * 3) for i in range(60)]
    texts.append(" ".join(["filler word"] * 90_000 + bench[3][1].split() + ["end"] * 150_000 + bench[4][1].split()[:10]))
    rows = _check(spark, documents(spark, texts), bench, block_pairs)
    assert sum(bool(r.spans) for r in rows) == 61


@pytest.mark.parametrize("block_pairs", [100_000, 1])
def test_empty(spark, block_pairs):
    none = documents(spark, [])
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(none, bench, block_pairs=block_pairs).count() == 0
    rows = contamination(awkward(spark), bench.limit(0), block_pairs=block_pairs).collect()
    assert len(rows) == 11 and not any(r.spans or r["items"] for r in rows)
    assert sum(r.n_words for r in rows) == sum(len(words(r.text)) for r in awkward(spark).collect())


def test_skips(monkeypatch):
    """Where no block of a window occurs, one of eight places is looked at."""
    searcher = decontamination.Searcher([[b"w%d" % i for i in range(10)]])
    seen = []
    searcher.shifts = type("Counting", (dict,), {"get": lambda self, k, d: seen.append(k) or dict.get(self, k, d)})(searcher.shifts)
    assert list(searcher.find([b"x"] * 8_000)) == []
    assert len(seen) <= 1_001


def test_one_passage_in_most_documents(spark):
    text = F.when(F.col("id") % 3 > 0, F.lit(" ".join("abcdefghijkl"))).otherwise(F.concat(F.lit("own "), F.col("id")))
    docs = spark.range(0, 6_000, 1, 8).select(F.col("id").alias("doc_id"), text.alias("text"))
    bench = spark.range(40).select(F.col("id").alias("item_id"), F.lit(" ".join("abcdefghijk")).alias("text"))
    for pairs in (100_000, 30):
        found = contamination(docs, bench, block_pairs=pairs)
        assert found.where("size(items) = 40 AND spans = array(named_struct('start', 0L, 'end', 11L))").count() == 4_000
        assert found.where("size(spans) = 0").count() == 2_000
