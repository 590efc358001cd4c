"""Operators that split their work, against plain loops."""

from __future__ import annotations

import random
import uuid
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from finloom import storage
from finloom.operators import chains, graph, sessions, similarity


def test_exponential_mean_over_ranges(spark):
    """One group is cut into ranges; another has a null, a third one row."""
    rng = random.Random(1)
    rows = [("big", i, rng.random() * 100) for i in range(6000)] + [("hole", i, None if i == 3 else float(i)) for i in range(8)] + [("one", 0, 5.0), (None, 0, 1.0), (None, 1, 2.0)]
    df = spark.createDataFrame(rows, "g string, o int, v double").repartition(7)
    expected, last = {}, {}
    for g, o, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        before = last.get(g, v)
        last[g] = None if before is None or v is None else 2 / 11 * v + 9 / 11 * before
        expected[g, o] = last[g]
    found = {(r.g, r.o): r.ema for r in chains.exponential_mean(df, ["g"], "o", "v", 10).collect()}
    assert found.keys() == expected.keys()
    assert all((found[k] is None) == (v is None) and (v is None or abs(found[k] - v) < 1e-5) for k, v in expected.items())
    assert chains.exponential_mean(df.where("g = 'none'"), ["g"], "o", "v", 10).count() == 0


def test_quota_against_a_loop(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), i, rng.choice([1.0, 5.0, 30.0, 99.0, 200.0])) for i in range(500)] + [("d", 0, None), ("e", 0, 500.0)]
    state = defaultdict(lambda: [0.0, 0, 0])
    for g, _, u in rows:
        s = state[g]
        if u is not None and s[0] + u <= 100:
            s[0], s[1] = s[0] + u, s[1] + 1
        else:
            s[2] += 1
    df = spark.createDataFrame(rows, "g string, o int, u double").repartition(5)
    found = {r.g: [r.used, r.accepted, r.rejected] for r in chains.quota_fold(df, ["g"], ["o"], "u", 100.0).collect()}
    assert found == dict(state)


def test_best_matches_on_a_grid(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PART_VECTORS", 50)
    rng = np.random.default_rng(3)
    vectors = rng.integers(-2, 3, (300, 4)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>")
    found = {r.query: (r.match, r.score) for r in similarity.best_matches(df, df.where("id % 7 = 0"), 1.0, block=10).collect()}
    for q in range(0, 300, 7):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        top = scores.max()
        assert found.get(q) == ((int(np.flatnonzero(scores == top)[0]), top) if top >= 1 else None)


def _random_graph(n: int, m: int, seed: int) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return sorted({(rng.randrange(n), rng.randrange(n)) for _ in range(m)})


def test_pair_distances(spark):
    edges = _random_graph(60, 70, 4)
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)

    def distance(a: int, b: int, most: int) -> int | None:
        seen, frontier, d = {a}, {a}, 0
        while b not in seen:
            frontier = {y for x in frontier for y in near[x]} - seen
            d += 1
            if not frontier or d > most:
                return None
            seen |= frontier
        return d

    pairs = [(random.Random(i).randrange(62), random.Random(-i - 1).randrange(62)) for i in range(80)]
    e = spark.createDataFrame(edges, "src int, dst int")
    p = spark.createDataFrame(pairs, "a int, b int")
    for hops in (1, 4, 15):
        found = {(r.a, r.b): r.distance for r in graph.pair_distances(e, p, hops).collect()}
        assert found == {(a, b): distance(a, b, hops) for a, b in pairs}


def _parts(edges: list[tuple[int, int]]) -> dict[int, int]:
    """The smallest vertex of the strongly connected part of every vertex on a cycle."""
    after = defaultdict(set)
    for a, b in edges:
        after[a].add(b)

    def reach(v: int) -> set[int]:
        seen, todo = set(), [v]
        while todo:
            for x in after[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        return seen

    far = {v: reach(v) for v in {x for e in edges for x in e}}
    return {v: min(u for u in far[v] if v in far[u]) for v in far if v in far[v]}


@pytest.mark.parametrize("n, m, seed", [(40, 60, 1), (25, 90, 3)])
def test_cyclic_components(spark, n, m, seed):
    """Many small parts, tails, loops and a ring longer than any bound; every witness is a shortest cycle."""
    edges = [*_random_graph(n, m, seed), *((500 + i, 500 + (i + 1) % 17) for i in range(17)), (510, 600), (600, 601), (700, 700), (700, 701), (0, 500)]
    e = spark.createDataFrame(edges, "src int, dst int")
    parts = graph.cyclic_components(e)
    expected = _parts(edges)
    rows = parts.collect()
    assert {r.vertex: r.component for r in rows} == expected and len(rows) == len(expected)
    ways = defaultdict(dict)
    for r in graph.witness_cycles(e, parts).collect():
        assert r.position not in ways[r.component]
        ways[r.component][r.position] = r.vertex
    assert set(ways) == set(expected.values())
    known = set(edges)
    for root, way in ways.items():
        path = [way[i] for i in range(len(way))]
        assert path[0] == root and len(set(path)) == len(path) and all(x in known for x in zip(path, [*path[1:], root]))
        near, d = {root}, 0
        while True:
            near, d = {b for a, b in known if a in near}, d + 1
            if root in near:
                break
        assert d == len(path)
    assert len(ways[500]) == 17 and len(ways[700]) == 1


def test_no_cycles(spark):
    none = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (None, 1)], "src int, dst int")
    parts = graph.cyclic_components(none)
    assert parts.count() == 0 and graph.witness_cycles(none, parts).count() == 0
    assert graph.cyclic_components(none.limit(0)).count() == 0


def test_distances_of_many_sources(spark):
    """More than one word of sources, pairs in both directions, ends without edges."""
    n = 200
    edges = [(i, i + 1) for i in range(n - 1)]
    pairs = [(a, b) for a in range(0, n, 2) for b in range(a % 7, n, 11)] + [(5, 5), (1000, 1000), (1000, 3), (None, 3), (None, None)]
    e, p = spark.createDataFrame(edges, "src int, dst int"), spark.createDataFrame(pairs, "a int, b int")
    found = {(r.a, r.b): r.distance for r in graph.pair_distances(e, p, 15).collect()}
    near = lambda a, b: None if a is None or b is None or (1000 in (a, b) and a != b) or abs(a - b) > 15 else abs(a - b)
    assert found == {(a, b): near(a, b) for a, b in pairs}


def test_short_cycles_through_a_hub(spark):
    """A hub with hundreds of edges in and out; every cycle of two and three is found once."""
    edges = set(_random_graph(80, 400, 7)) | {(0, i) for i in range(1, 300)} | {(i, 0) for i in range(300, 600)} | {(1, 300), (2, 301), (3, 3)}
    e = {(a, b) for a, b in edges if a != b}
    expected = {(a, b, None) for a, b in e if a < b and (b, a) in e}
    after = defaultdict(set)
    for a, b in e:
        after[a].add(b)
    expected |= {(a, b, c) for a, b in e if a < b for c in after[b] if a < c and a in after[c]}
    found = [tuple(r) for r in graph.short_cycles(spark.createDataFrame(sorted(edges), "src long, dst long")).select("a", "b", "c").collect()]
    assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 20


@pytest.mark.parametrize("common", [3000, 0])
def test_shared_members_of_a_common_group(spark, common):
    """Everything is in one group, or no group is large; few items share a second one."""
    rng = random.Random(6)
    rows = {(i, -1) for i in range(common)} | {(rng.randrange(300), rng.randrange(40)) for _ in range(900)}
    groups = defaultdict(set)
    for i, g in rows:
        groups[i].add(g)
    for least in (2, 4):
        expected = set()
        for a in range(300):
            for b in range(a + 1, 300):
                both = groups[a] & groups[b]
                if len(both) >= least:
                    expected.add((a, b, len(both), min(both)))
        found = graph.shared_members(spark.createDataFrame(sorted(rows), "item int, group int"), least)
        assert {tuple(r) for r in found.select("a", "b", "n_shared", "first_group").collect()} == expected


def test_pairs_of_groups_are_dealt_over_tasks(spark, monkeypatch):
    """However many pairs there are, also of one group, a task makes a bounded number."""
    monkeypatch.setattr(graph, "TASK_PAIRS", 500)
    most, meeting = [], graph._meeting

    def spy(*args):
        met = meeting(*args)
        most.append(max(r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()))
        return met

    monkeypatch.setattr(graph, "_meeting", spy)
    rows = [(i, 0) for i in range(150)] + [(i, g) for g in range(1, 90) for i in range(g, g + 15)]
    groups = defaultdict(set)
    for i, g in rows:
        groups[i].add(g)
    df = spark.createDataFrame(rows, "item int, group int")
    for least, limit in ((1, None), (3, None), (2, 20)):
        own = {i: g - {0} if limit else g for i, g in groups.items()}
        both = {(a, b): own[a] & own[b] for a in own for b in own if a < b}
        found = {tuple(r) for r in graph.shared_members(df, least, limit).select("a", "b", "n_shared", "first_group").collect()}
        assert found == {(a, b, len(g), min(g)) for (a, b), g in both.items() if len(g) >= least}
    assert len(most) == 3 and max(most) <= 6 * 500


def test_known_duplicates_of_a_common_title(spark):
    """A title of very many known items: the first of them is the answer."""
    known = spark.range(2000).select((1999 - F.col("id")).alias("pos"), F.col("id"), F.concat(F.lit("https://a.com/"), F.col("id")).alias("url"), F.lit("Markets rise on rates").alias("title"))
    new = spark.range(300).select("id", F.lit("https://b.com").alias("url"), F.lit("markets RISE on rates").alias("title"))
    found = sessions.known_duplicates(new, known)
    assert found.count() == 300
    assert {(r.known_id, r.reason) for r in found.collect()} == {(1999, "title")}


def test_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_dir", lambda spark, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}")
    links = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    found = graph.components(links)
    assert found.count() == 30
    # Of all rounds only the last is left.
    assert len(list(tmp_path.iterdir())) == 1
    storage.discard(found)
    assert list(tmp_path.iterdir()) == []
    with storage.temporary(spark) as kept:
        first = storage.materialise(links, "first")
        kept.append(storage.materialise(first.where("a > 10"), "second"))
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["second"]
    assert kept[0].count() == 19
    storage.release(spark)
    assert list(tmp_path.iterdir()) == []


class _Session:
    """A session by its settings alone."""

    def __init__(self, **conf: str):
        self.values = {k.replace("_", "."): v for k, v in conf.items()}
        self.conf = self

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.values.get(key, default)


def test_a_cluster_needs_a_shared_folder():
    assert storage.shared_dir(_Session(spark_master="local[4]"), "x").startswith("file://")
    assert storage.shared_dir(_Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///c/"), "x").startswith("hdfs:///c/x-")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="checkpoint"):
            storage.shared_dir(_Session(spark_master=master), "x")


def test_sets_apart_are_not_fetched(spark, monkeypatch):
    """Sets that share their rarest tokens but little else make no candidates, similar ones do."""
    compared, own = [], similarity.jaccard
    monkeypatch.setattr(similarity, "jaccard", lambda a, b: F.when(F.raise_error(F.lit("compared")).isNull(), 0.0) if compared else own(a, b))
    rng = random.Random(8)
    common = [f"w{i}" for i in range(60)]
    # Two tokens that few sets hold, and others of sixty that very many hold.
    sets = [(i, sorted({"rare", "seldom", *rng.sample(common, 18)})) for i in range(120)]
    near = [(1000, sets[0][1][1:]), (1001, sets[1][1] + ["other"])]
    many = [(2000 + i, sorted({f"own{i}-{k}" for k in range(30)} | set(common))) for i in range(150)]
    schema = "id long, words array<string>"
    pairs = {(r.a, r.b) for r in similarity.similar_sets(spark.createDataFrame(sets + near + many, schema), "id", "words", 0.8).collect()}
    size = dict((i, set(w)) for i, w in sets + near + many)
    assert pairs == {(a, b) for a in size for b in size if a < b and len(size[a] & size[b]) / len(size[a] | size[b]) >= 0.8 - 1e-9}
    assert {(0, 1000), (1, 1001)} <= pairs
    compared.append(True)
    far = [(i, w) for i, w in sets if all(len(set(w) & set(v)) < 15 for j, v in sets if j < i)]
    assert len(far) > 20 and similarity.similar_sets(spark.createDataFrame(far + many, schema), "id", "words", 0.8).count() == 0


def test_similar_classes_against_all_pairs(spark):
    """Sets with copies (one of them a third of all rows), near copies, chains, and rows without tokens."""
    rng = random.Random(11)
    sets = [None, [], ["a", None, "a"], ["a"]] + [["hot", "w", "x", "y", "z"]] * 60
    for _ in range(25):
        base = [f"t{rng.randrange(40)}" for _ in range(rng.randrange(3, 12))]
        for _ in range(4):
            sets.append(base + [f"u{rng.randrange(300)}" for _ in range(rng.randrange(2))] + base[:1])
    rng.shuffle(sets)
    df = spark.createDataFrame([(i, s, "other") for i, s in enumerate(sets)], "id long, words array<string>, n_copies string").repartition(5)
    plain = [frozenset(w for w in s or [] if w is not None) for s in sets]
    alike = [[j for j, b in enumerate(plain) if i != j and a and len(a & b) >= 0.8 * len(a | b) - 1e-9] for i, a in enumerate(plain)]
    first = list(range(len(sets)))
    for _ in sets:
        first = [min([first[i], *(first[j] for j in alike[i])]) for i in range(len(sets))]
    found = {r.id: (r.class_id, r.n_copies, r.n_links) for r in similarity.similar_classes(df, "id", "words", 0.8).collect()}
    assert found == {i: (first[i], 1 if not a else plain.count(a), len(alike[i])) for i, a in enumerate(plain)}
    assert any(len(x) > 50 for x in alike) and len({v[0] for v in found.values()}) < len(set(plain))
    assert similarity.similar_classes(df.where("id < 0"), "id", "words", 0.8).count() == 0


def test_searches_leave_their_result_alone(spark, tmp_path, monkeypatch):
    """Steps of a search are deleted when it returns; its result and what it reads stay."""
    storage.release(spark)
    monkeypatch.setattr(storage, "shared_dir", lambda spark, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}")
    ring = [(i, (i + 1) % 6) for i in range(6)] + [(6, 0), (6, 6)]
    edges = storage.materialise(spark.createDataFrame(ring, "src long, dst long"), "edges")
    start = spark.createDataFrame([(0,)], "id long")
    hops = graph.hop_distances(edges, start, 5)
    assert {r.id: r.distance for r in hops.collect()} == {0: 0, 1: 1, 5: 1, 6: 1, 2: 2, 4: 2, 3: 3}
    pairs = graph.pair_distances(edges, spark.createDataFrame([(1, 4), (3, 6), (None, 2)], "a long, b long"), 3)
    assert {(r.a, r.b): r.distance for r in pairs.collect()} == {(1, 4): 3, (3, 6): None, (None, 2): None}
    parts = graph.cyclic_components(edges)
    ways = graph.witness_cycles(edges, parts)
    assert sorted(map(tuple, ways.collect())) == [(0, i, i) for i in range(6)] + [(6, 0, 6)]
    assert similarity.similar_classes(spark.createDataFrame([(1, ["a"]), (2, ["a"])], "id long, w array<string>"), "id", "w", 0.9).count() == 2
    left = sorted(p.name.rpartition("-")[0] for p in tmp_path.iterdir())
    assert left == ["distances", "edges", "hops", "parts", "similar-verdicts", "witnesses"]
    storage.release(spark)


def test_searches_make_their_edges_once(spark):
    """Not for each step, nor for each direction."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(i, i + 1) for i in range(10)], "src long, dst long")
    seen = graph.hop_distances(edges.mapInArrow(counted, edges.schema), spark.createDataFrame([(0,)], "id long"), 4)
    assert {(r.id, r.distance) for r in seen.collect()} == {(i, i) for i in range(5)} and read.value == 10
    found = graph.pair_distances(edges.mapInArrow(counted, edges.schema), spark.createDataFrame([(0, 3), (9, 7)], "a long, b long"), 4)
    assert {(r.a, r.b, r.distance) for r in found.collect()} == {(0, 3, 3), (9, 7, 2)} and read.value == 20
