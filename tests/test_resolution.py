from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import MEDIUM

from finloom.operators import resolution, similarity, vectors
from finloom.plans.catalog import QUERIES


def lev(a: str, b: str) -> float:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return 1 - row[-1] / max(len(a), len(b), 1)


def brute(names, master, aliases, t):
    out = {}
    for name, kind in set(names):
        title = {str(i): n for i, n, _ in master}
        layers = [
            ("exact", [(1.0, "", n, str(i)) for i, n, k in master if n == name and (kind is None or k == kind)]),
            ("exact_name", [(1.0, "", n, str(i)) for i, n, _ in master if n == name]),
            ("alias_fuzzy", [(lev(name or "", a), a, title[str(i)], str(i)) for a, i in aliases if a and str(i) in title and name and lev(name, a) > t + 1e-12]),
            ("name_fuzzy", [(lev(name or "", n), "", n, str(i)) for i, n, _ in master if n and name and lev(name, n) > t + 1e-12]),
        ]
        out[name, kind] = None
        if name:
            for layer, found in layers:
                if found:
                    s, a, n, i = min(found, key=lambda x: (-x[0], *x[1:]))
                    out[name, kind] = (i, n, a or None, round(s, 9), layer)
                    break
    return out


@pytest.mark.parametrize("seed, t", [(1, 0.8), (2, 0.6)])
def test_layers(spark, seed, t):
    """Equal names of several types, near aliases and names, ties, nulls and empty texts."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randrange(3, 12))) for _ in range(25)]

    def bent(x: str) -> str:
        at = rng.randrange(len(x))
        return rng.choice([x, x[:at] + "z" + x[at:], x[:at] + x[at + 1 :], x[:at] + "y" + x[at + 1 :], x.upper()])

    master = [(i, rng.choice(base), rng.choice(["p", "q", None])) for i in range(30)] + [(99, None, "p"), (98, "", "p")]
    aliases = [(bent(rng.choice(base)), rng.randrange(35)) for _ in range(25)] + [(None, 1), ("", 2)]
    names = [(bent(rng.choice(base)), rng.choice(["p", "q", None])) for _ in range(60)] + [(None, "p"), ("", None), ("nothing like it", "p")]
    found = resolution.resolve_by_text(
        spark.createDataFrame(names, "name string, type string"), spark.createDataFrame(master, "id int, name string, type string"), spark.createDataFrame(aliases, "alias string, id int"), t
    ).collect()
    got = {(r.name, r.type): (r.id, r.match, r.matched_alias, round(r.similarity, 9), r.layer) if r.layer else None for r in found}
    assert len(got) == len(found) and got == brute(names, master, aliases, t)
    assert len({r.layer for r in found}) >= 4


def test_common_names_join_one_row(spark, monkeypatch):
    """Masters and aliases of one name make no row each for whoever asks for it."""
    rows, best = [], resolution._best
    monkeypatch.setattr(resolution, "_best", lambda found, layer: (rows.append(found.count()), best(found, layer))[1])
    master = spark.range(400).select("id", F.lit("common name").alias("name"), (F.col("id") % 4).cast("string").alias("type"))
    aliases = spark.range(400).select(F.lit("an alias of all").alias("alias"), "id")
    asked = [("common name", "3"), ("common name", None), ("common name", "none"), ("an alias of al", None), ("common names", "x")]
    found = resolution.resolve_by_text(spark.createDataFrame(asked, "name string, type string"), master, aliases)
    got = {(r.name, r.type): (r.id, r.match, r.matched_alias, r.layer) for r in found.collect()}
    assert got == {
        asked[0]: ("103", "common name", None, "exact"), asked[1]: ("0", "common name", None, "exact"), asked[2]: ("0", "common name", None, "exact_name"),
        asked[3]: ("0", "common name", "an alias of all", "alias_fuzzy"), asked[4]: ("0", "common name", None, "name_fuzzy"),
    }
    assert sum(rows) <= 4 * len(asked)


def test_chain(spark):
    names = spark.createDataFrame([("known", "p"), ("by vector", "p"), ("far", "p"), ("no vector", None), ("by vector", None)], "name string, type string")
    master = spark.createDataFrame([(1, "known", "p"), (2, "other thing", "q"), (3, "third thing", "q")], "id int, name string, type string")
    none = spark.createDataFrame([], "alias string, id int")
    of_names = spark.createDataFrame([("by vector", [0.0, 1.0]), ("far", [-1.0, 0.0]), ("known", [0.0, 1.0])], "name string, vector array<double>")
    of_master = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.1, 0.9]), (3, [0.1, 0.9]), (4, None)], "id int, vector array<double>")

    def by_index(known, asked, near):
        return vectors.indexed_matches(vectors.build_index(known, 2), asked, 2, near)

    for matches in (similarity.best_matches, by_index):
        rows = {(r.name, r.type): (r.id, r.match, r.similarity, r.layer, r.resolved) for r in resolution.resolve_all(names, master, none, of_names, of_master, matches=matches).collect()}
        assert rows == {
            ("known", "p"): ("1", "known", 1.0, "exact", True), ("by vector", "p"): ("2", "other thing", 0.9, "embedding", True), ("by vector", None): ("2", "other thing", 0.9, "embedding", True),
            ("far", "p"): (None, None, None, "new", False), ("no vector", None): (None, None, None, "new", False),
        }


def _vectors(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, vector array<double>")


def test_all_cells_are_exact(spark):
    """With every cell probed, and hot cells cut into parts and blocks, nothing is missed."""
    points = np.random.default_rng(1).normal(size=(300, 8))
    points[100:200] = points[100] + np.random.default_rng(2).normal(size=(100, 8)) / 50
    points[250] = points[251]
    rows = _vectors(spark, points)
    index = vectors.build_index(rows, 12)
    assert index.rows.count() == 300
    asked = rows.where("id % 5 = 0")
    exact = sorted(map(tuple, similarity.best_matches(rows, asked, 0.0).collect()))
    for block, part in ((10**6, 10**6), (7, 11)):
        assert sorted(map(tuple, vectors.indexed_matches(index, asked, 12, 0.0, block=block, part=part).collect())) == exact


def test_few_cells_suffice_for_clusters(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 5
    rows = _vectors(spark, centres[rng.integers(20, size=1500)] + rng.normal(size=(1500, 16)))
    index = vectors.build_index(rows, 20, sample_rows=400)
    probes = vectors.probes_for(index, sample_queries=100)
    asked = rows.where("id % 10 = 0")
    exact = similarity.best_matches(rows, asked, 0.0)
    assert probes <= 5 and vectors.recall(vectors.indexed_matches(index, asked, probes, 0.0), exact) >= 0.9


def test_recall_of_the_query(spark):
    """Vectors without clusters: most cells are probed, and recall is still at least 0.9."""
    rows = spark.read.parquet(f"{MEDIUM}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    asked = rows.where("id % 10 = 0")
    index = vectors.build_index(rows, 22)
    exact = similarity.best_matches(rows, asked, 0.3).cache()
    assert vectors.recall(vectors.indexed_matches(index, asked, vectors.probes_for(index), 0.3), exact) >= 0.9
    found = QUERIES["vector_index_matches"](spark, MEDIUM)
    assert vectors.recall(found, similarity.best_matches(rows, rows.where("id % 100 = 0"), 0.3)) >= 0.9


def test_no_vectors(spark):
    none = spark.createDataFrame([], "id long, vector array<double>")
    index = vectors.build_index(none, 4)
    assert vectors.indexed_matches(index, none, vectors.probes_for(index), 0.0).count() == 0
