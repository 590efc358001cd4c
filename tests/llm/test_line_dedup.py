from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F
from tests.conftest import MEDIUM

from finloom.llm.line_dedup import dedup_lines
from tests.llm.helpers import awkward, documents


def brute(rows) -> list[tuple]:
    """rows: (doc_id, row_hash, text)."""
    first: dict = {}
    order = sorted({(r[0] is not None, r[0] or 0, r[1], r[2]) for r in rows})
    for *place, text in order:
        lines = text.split("\n")
        for i in range(len(lines) - 2):
            first.setdefault(tuple(lines[i : i + 3]), (*place, i))
    out = []
    for doc_id, row_hash, text in rows:
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            if first[tuple(lines[i : i + 3])] != (doc_id is not None, doc_id or 0, row_hash, i):
                gone |= {i, i + 1, i + 2}
        out.append((doc_id, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def _check(docs):
    text = F.coalesce("text", F.lit(""))
    rows = [tuple(r) for r in docs.select("doc_id", F.xxhash64(text, F.length(text)), text).collect()]
    found = dedup_lines(docs)
    assert Counter((r.row.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in found.collect()) == Counter(brute(rows))


def test_real_documents(spark):
    _check(spark.read.parquet(f"{MEDIUM}/documents.parquet"))


def test_awkward_and_columns(spark):
    docs = awkward(spark)
    _check(docs)
    assert dedup_lines(docs).select("row.*").columns == docs.columns


def test_empty(spark):
    assert dedup_lines(documents(spark, [])).count() == 0


def test_overlaps_and_repeats_inside_a_document(spark):
    rng = random.Random(1)
    texts = ["\n".join(f"line {rng.randrange(4)}" for _ in range(rng.randrange(12))) for _ in range(80)]
    _check(documents(spark, texts + ["a\na\na\na\na\na"], ids=[i // 2 for i in range(81)]))
