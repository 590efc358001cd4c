from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
from tests.conftest import MEDIUM, SMALL

from finloom.llm import quality_rules
from finloom.llm.quality_rules import quality_verdicts
from tests.llm.helpers import awkward, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, share=0.1, docs=20, left=0.5) -> list[tuple]:
    texts = [r.text or "" for r in rows]
    lines = []
    for t in texts:
        count = Counter()
        for line in t.split("\n"):
            if words := WORD.findall(line):
                count[" ".join(words).lower()] += len(words)
        lines.append(count)
    holders, hosts = defaultdict(set), defaultdict(set)
    for r, t, own in zip(rows, texts, lines):
        hosts[r.source].add(t)
        for line in own:
            holders[r.source, line].add(t)
    out = []
    for r, t, own in zip(rows, texts, lines):
        words = WORD.findall(t)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        counts = Counter(grams)
        repeated = {j for i, g in enumerate(grams) if counts[g] > 1 for j in range(i, i + 3)}
        cut = [x for x in t.split("\n") if WORD.search(x)]
        common = {x for x in own if len(holders[r.source, x]) > docs and len(holders[r.source, x]) > share * len(hosts[r.source])}
        gone = sum(own[x] for x in common)
        kept = "\n".join(x for x in t.split("\n") if " ".join(WORD.findall(x)).lower() not in common)
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        out.append((
            r.doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(cut) - len(set(cut)), len(repeated), gone, kept, failed,
            not failed and len(words) - gone >= left * len(words),
        ))
    return out


def _check(docs):
    rows = docs.collect()
    found = Counter(
        (r.row.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_boilerplate_words, r.kept_text, r.base_failed, r.kept)
        for r in quality_verdicts(docs).collect()
    )
    assert found == Counter(brute(rows))


def test_real_documents(spark):
    _check(spark.read.parquet(f"{MEDIUM}/documents.parquet"))


def test_awkward(spark):
    _check(awkward(spark))


def test_lines_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "BROADCAST_LINES", -1)
    _check(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_empty(spark):
    assert quality_verdicts(documents(spark, [])).count() == 0


def test_boilerplate_depletes_documents(spark):
    """A footer of most of a host's documents counts against those that are
    little else, in that host only."""
    footer = "\n".join(" ".join(f"foot{i}x{j}" for j in range(20)) for i in range(3))
    own = lambda i, n: " ".join(f"own{i}w{j}" for j in range(n))
    texts = [f"{own(i, 100)}\n{footer}" for i in range(30)] + [f"{own(99, 30)}\n{footer}", f"{own(98, 30)}\n{footer}", own(97, 60)]
    sources = ["a"] * 30 + ["a", "b", None]
    docs = documents(spark, texts, sources)
    _check(docs)
    kept = {r.row.doc_id: r.kept for r in quality_verdicts(docs).collect()}
    assert kept[0] and not kept[30] and kept[31] and kept[32]


def test_the_stage_removes_boilerplate(spark):
    """Lines above the limit leave the text, in every spelling; other lines stay in order."""
    own = lambda i: " ".join(f"own{i}w{j}" for j in range(60))
    texts = [f"Read  MORE here\n{own(i)}\n\nread more here\nlast{i} line" for i in range(30)]
    docs = documents(spark, texts + [texts[0], own(99)], ["a"] * 31 + ["b"])
    out = {r.doc_id: (r.text, r.n_chars, r.lang) for r in corpus_pipeline.quality(spark, docs, SMALL).collect()}
    cut = [f"{own(i)}\n\nlast{i} line" for i in [*range(30), 0]] + [own(99)]
    assert out == {i: (t, len(t), "en") for i, t in enumerate(cut)}
