"""Literal rows for the relational operators, sources and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from finloom.operators import chains, dedup, graph, grouping, similarity
from finloom.sources import documents as sources
from finloom.streaming import incremental


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect()) if columns else sorted(map(tuple, df.collect()))


def test_dedup(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, None, 3), (3, None, 4)], "pos int, k string, v int")
    assert rows(dedup.first_wins(df, ["k"], ["pos"]), "pos") == [(0,), (2,)]
    assert rows(dedup.latest_wins(df, ["k"], ["pos"]), "pos") == [(1,), (3,)]
    known = df.where("pos = 0")
    assert rows(dedup.new_rows(df, known, "k"), "pos") == [(2,), (3,)]
    assert rows(dedup.upsert(known, df.where("pos = 1"), "k"), "pos") == [(1,)]
    added = dedup.insert_absent(known, spark.createDataFrame([(7, "b", 1), (8, "b", 2), (9, "a", 3)], df.schema), "k", ["pos"])
    assert rows(added, "pos", "added") == [(0, False), (7, True)]
    kept = dedup.upsert_keep(
        spark.createDataFrame([("x", 1, 2), ("y", 1, 2)], "k string, a int, b int"), spark.createDataFrame([("x", None, 5), ("z", 1, None)], "k string, a int, b int"), "k"
    )
    assert sorted((r.k, r.a, r.b) for r in kept.collect() if r.k != "z") == [("x", 1, 5), ("y", 1, 2)]


def test_unseen_null_policy(spark):
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    old = spark.createDataFrame([("a", dt.datetime(2024, 1, 9)), ("b", None), ("c", dt.datetime(2020, 1, 1))], "k string, at timestamp")
    assert rows(dedup.unseen(new, old, "k", "at", "2024-01-01", True), "k") == [("c",)]
    assert rows(dedup.unseen(new, old, "k", "at", "2024-01-01", False), "k") == [("b",), ("c",)]


def test_trend_is_not_bridged_over_a_null(spark):
    df = spark.createDataFrame([("g", 1, "p1", 1.0), ("g", 2, "p2", None), ("g", 3, "p3", 2.0), ("g", 4, "p4", 3.0)], "g string, o int, p string, v double")
    assert rows(chains.trend_edges(df, ["g"], ["o"], "p", "v")) == [("g", "p3", "p4", 50.0, "up")]


def test_quota_rejects_without_adding(spark):
    df = spark.createDataFrame([("u", 1, 60.0), ("u", 2, 50.0), ("u", 3, 40.0), ("v", 1, 500.0)], "u string, o int, n double")
    assert rows(chains.quota_fold(df, ["u"], ["o"], "n", 100.0)) == [("u", 2, 1, 100.0, 0.0), ("v", 0, 1, 0.0, 100.0)]


def test_best_and_worst_overlap(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 0.0)], "n string, v double")
    found = chains.best_and_worst(df, "v", "n", 2)
    assert rows(found, "side", "place", "n") == [("bottom", 1, "b"), ("bottom", 2, "c"), ("top", 1, "a"), ("top", 2, "c")]


def test_empty_groups(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert rows(grouping.entropy(none, "k", "x")) == [("x", 0.0)]
    assert rows(grouping.rule_result(none, "r", F.col("v") > 0)) == [("r", 0, 0, 1.0)]
    assert rows(grouping.fixed_buckets(none, F.col("k"), ("a", "b"))) == [("a", 0), ("b", 0)]


def test_status_directions(spark):
    df = spark.createDataFrame([("avg_degree", 3.0), ("avg_degree", 1.5), ("orphan_node_ratio", 0.05), ("orphan_node_ratio", 0.2), ("new", 9.0)], "m string, v double")
    assert [r.s for r in df.select(grouping.metric_status(F.col("m"), F.col("v")).alias("s")).collect()] == ["green", "yellow", "green", "red", "yellow"]


def test_graph(spark):
    nodes = spark.createDataFrame([(x,) for x in "abcdef"], "id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "e"), ("e", "e")], "src string, dst string")
    assert rows(graph.component_sizes(nodes, edges)) == [("a", 3), ("d", 2), ("f", 1)]
    assert rows(graph.without_edges(nodes, edges)) == [("f",)]
    assert rows(graph.hop_distances(edges, nodes.where("id = 'a'"), 5)) == [("a", 0), ("b", 1), ("c", 1)]
    numbered = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (2, 1), (4, 4)], "src long, dst long")
    assert sorted(map(tuple, graph.short_cycles(numbered).collect()), key=str) == [(1, 2, 3), (1, 2, None)]
    layers = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 0)], "id long, layer int")
    assert rows(graph.layer_violations(numbered, layers), "src", "dst") == [(1, 2), (2, 3)]
    typed = edges.withColumn("type", F.lit("t"))
    assert rows(graph.valid_edges(nodes.where("id <> 'e'"), typed), "src", "dst", "broken") == [("a", "b", False), ("b", "c", False), ("c", "a", False), ("d", "e", True)]


def test_resolve_names(spark):
    names = spark.createDataFrame([("Microsoft",), ("microsft",), ("apple",), ("zzz",), (None,), ("",)], "name string")
    master = spark.createDataFrame([("microsoft",), ("Apple",), ("apples and pears",)], "name string")
    assert [(r.name, r.match, r.layer) for r in similarity.resolve_names(names, master).orderBy("name").collect()] == [
        ("apple", "apple", "exact"), ("microsft", "microsoft", "fuzzy"), ("microsoft", "microsoft", "exact"), ("zzz", None, "new"),
    ]


def test_best_matches_ties_and_nulls(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 1.0])], "id long, vector array<float>")
    assert rows(similarity.best_matches(v, v.where("id in (1, 4, 5)"), 0.8)) == [(1, 2, 1.0)]
    assert similarity.best_matches(v, v.where("id = 9"), 0.8).count() == 0


def test_citations_follow_input_order(spark):
    papers = spark.createDataFrame([(0, "a", ["b", "x"]), (1, "b", ["a", "b"]), (2, "c", None)], "pos long, id string, cites array<string>")
    assert rows(similarity.citations_in_order(papers, spark.createDataFrame([("x",)], "id string"))) == [("a", "x"), ("b", "a")]


def test_sources(spark):
    rss = "<rss><channel><item><title>T</title><link>http://a</link><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item><item><title>no link</title></item></channel></rss>"
    items = sources.feed_items(spark.createDataFrame([("f", rss), ("g", "nonsense"), ("h", None)], "feed string, content string"), "feed", "content")
    assert [(r.feed, r.title, r.link, str(r.published)) for r in items.collect()] == [("f", "T", "http://a", "2024-01-01 10:00:00")]
    urlset = "<urlset><url><loc>http://a/1</loc><priority>0.5</priority></url><url><loc>http://a/2</loc><priority>high</priority></url></urlset>"
    entries = sources.sitemap_entries(spark.createDataFrame([("m", urlset)], "k string, c string"), "k", "c")
    assert rows(entries, "loc") == [("http://a/1",), ("http://a/2",)]
    assert {r.loc: r.priority for r in entries.collect()} == {"http://a/1": 0.5, "http://a/2": None}
    index = lambda *x: "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in x) + "</sitemapindex>"
    maps = spark.createDataFrame([("r", index("a", "b")), ("a", index("c", "r")), ("b", urlset), ("c", urlset), ("lost", urlset)], "url string, content string")
    assert rows(sources.sitemap_tree(maps, "r")) == [("a",), ("b",), ("c",), ("r",)]
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.500\n<c>Hello</c> there\n\n00:02.500 --> 00:03.000\nHello there\n\n01:00:00.000 --> 01:00:01.000\nBye"
    cues = sources.caption_cues(spark.createDataFrame([("v", vtt)], "k string, c string"), "k", "c")
    assert rows(cues, "start", "end", "text") == [(1.0, 2.5, "Hello there"), (3600.0, 3601.0, "Bye")]


def test_markdown_and_pages(spark):
    md = "---\nurl: http://a\ntitle: 'T'\n---\nintro\n# One\ntext\n## Two\nmore"
    row = spark.createDataFrame([(md,)], "t string").select(
        sources.frontmatter(F.col("t")).alias("f"), sources.sections(F.lit("intro\n# One\ntext\n## Two\nmore")).alias("s")
    ).first()
    assert row.f == {"url": "http://a", "title": "T"}
    assert row.s == ["intro\n", "# One\ntext\n", "## Two\nmore"]
    heads = spark.createDataFrame([(x,) for x in row.s], "t string").select(sources.section_heading(F.col("t")).alias("h"))
    assert [r.h for r in heads.collect()] == [None, "One", "Two"]
    html = "<body><nav>menu</nav><article><h1>T</h1><script>x</script><p>body <a href='/a.PDF?x'>pdf</a></p></article></body>"
    pages = spark.createDataFrame([(html,), ("<p>plain</p>",), (None,)], "h string")
    assert [r.t for r in pages.select(sources.article_text("h").alias("t")).collect()] == ["T\nbody\npdf", "plain", ""]
    assert pages.select(sources.pdf_links(F.col("h")).alias("l")).first().l == ["/a.PDF?x"]
    robots = spark.createDataFrame([("User-agent: *\nNoAI: yes\nnoai: no\nDisallow: /",)], "t string")
    assert robots.select(sources.robots_directives(F.col("t")).alias("d")).first().d == {"noai": "no"}


def test_streams(spark, tmp_path):
    for n, part in enumerate([[(1, "u", 60.0), (2, "u", 50.0)], [(3, "u", 40.0), (4, "v", 5.0)]]):
        spark.createDataFrame(part, "o long, u string, n double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = incremental.stream_of(spark, str(tmp_path / "in"), "o long, u string, n double")
    fresh = incremental.new_items(stream, spark.createDataFrame([(2,), (2,)], "o long"), "o").select("o")
    assert rows(incremental.run_once(fresh, str(tmp_path / "fresh"))) == [(1,), (3,), (4,)]
    quota = incremental.quota(stream, "u", "o", "n", 100.0)
    out = quota.writeStream.format("memory").queryName("quota").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    out.awaitTermination()
    last = spark.sql("SELECT u, max_by(struct(used, accepted, rejected), accepted + rejected) AS s FROM quota GROUP BY u")
    assert {r.u: tuple(r.s) for r in last.collect()} == {"u": (100.0, 2, 1), "v": (5.0, 1, 0)}


def test_windows_and_first_seen_on_streams(spark, tmp_path):
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    for part in ([(at(10, 0), "a"), (at(10, 30), "a")], [(at(11, 10), "a")], [(at(14, 0), "b")], [(at(10, 5), "a")]):
        spark.createDataFrame(part, "t timestamp, k string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = incremental.stream_of(spark, str(tmp_path / "in"), "t timestamp, k string")
    counts = incremental.run_once(incremental.windowed_counts(stream, "t", "k", "1 hour", "30 minutes"), str(tmp_path / "windows"))
    found = {(r.start.hour, r.k): r.n for r in counts.collect()}
    # The window of 14:00 is still open, and a row of 10:05 may have come too late.
    assert found[(11, "a")] == 1 and found[(10, "a")] in (2, 3) and (14, "b") not in found
    first = incremental.first_seen(incremental.stream_of(spark, str(tmp_path / "in"), "t timestamp, k string"), "k", "t", "2 days")
    assert rows(incremental.run_once(first.select("k"), str(tmp_path / "first"))) == [("a",), ("b",)]
