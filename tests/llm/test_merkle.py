from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL

from finloom.llm import merkle
from tests.llm.helpers import awkward, documents, executed, many_partitions


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    values = (row[f] for f in merkle.FIELDS)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top, and the path of every node."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        new_nodes, new_under = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for i in range(len(run)):
                for k in under[at + i]:
                    paths[k].append(("".join(run[:i]), "".join(run[i + 1 :])))
            new_nodes.append(H("".join(run)))
            new_under.append(sum(under[at : at + 8], []))
        nodes, under = new_nodes, new_under
    return nodes[0], paths


def brute(rows) -> Counter:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    tops, found = [], []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        top, paths = tree([leaf(r) for r in own])
        tops.append(top)
        found.append((own, paths))
    root, upper = tree(tops) if tops else ("", [])
    out: Counter = Counter()
    for (own, paths), top, above in zip(found, tops, upper):
        for r, path in zip(own, paths):
            out[r.doc_id, leaf(r), top, root, tuple(path + above)] += 1
    return out


def check(docs):
    found = merkle.manifest(docs)
    path = F.transform("path", lambda p: F.concat_ws("|", merkle.shown(p.left), merkle.shown(p.right)))
    rows = found.select("doc_id", *(merkle.shown(F.col(c)) for c in ("leaf", "subroot", "root")), path, merkle.shown(merkle.fold(F.col("leaf"), F.col("path")))).collect()
    assert Counter((r[0], r[1], r[2], r[3], tuple(tuple(x.split("|")) for x in r[4])) for r in rows) == brute(docs.collect())
    assert all(r[5] == r[3] for r in rows)


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (8, 9), (2, 1, 65), (70, 3, 64, 8, 1, 1, 1, 1, 1, 2)])
def test_shapes(spark, sizes):
    """Lone leaves, full and short runs, several levels, more groups than a run."""
    texts = [f"text {i}" for i in range(sum(sizes))]
    langs = [None if g == 1 else f"é{g}" for g, n in enumerate(sizes) for _ in range(n)]
    docs = documents(spark, texts).withColumn("lang", F.element_at(F.array(*map(F.lit, langs)), (F.col("doc_id") + 1).cast("int")))
    check(docs.repartition(3))


def test_awkward(spark):
    check(awkward(spark))


def test_repeated_rows(spark):
    check(documents(spark, ["same"] * 40 + ["other"] * 30, ids=[5] * 40 + [None] * 30))


def test_given(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_empty(spark):
    assert merkle.manifest(documents(spark, [])).count() == 0


def test_tampering_is_found(spark):
    docs = documents(spark, ["Aa", "bb", "Cc", None, "dd"])
    changed = merkle.leaf_digest(*(F.lower("text") if f == "text" else F.col(f) for f in merkle.FIELDS))
    found = merkle.manifest(docs, carried={"changed": changed})
    fine = found.where(merkle.fold(F.col("changed"), F.col("path")) == F.col("root")).select("doc_id").collect()
    assert {r.doc_id for r in fine} == {1, 3, 4}


def test_a_group_of_most_rows(spark):
    """One language and one id in most rows: no task holds the group."""
    with many_partitions(spark):
        docs = spark.range(0, 8_000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
            F.lit(1).alias("n_chars"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.md5(F.col("id").cast("string"))).alias("text"),
        )
        found = merkle.manifest(docs)
        assert "Cartesian" not in executed(found.select("root"))
        ok = found.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"))
        assert ok.count() == 8_000 and found.select("root").distinct().count() == 1
