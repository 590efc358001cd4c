"""Literal rows for session preparation, dates, sinks and folders of files."""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from finloom import sinks
from finloom.functions import dates
from finloom.operators import sessions
from finloom.sources import files


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_known_duplicates(spark):
    known = spark.createDataFrame([(0, 10, "https://a.com/x", "Fed raises rates by a quarter point today"), (1, 11, "https://b.com/y/", "Other"), (2, 12, None, None)], "pos long, id long, url string, title string")
    new = spark.createDataFrame(
        [(1, "https://www.b.com/y?utm_source=q", "Fed raises rates by a quarter point today"), (2, "https://b.com/y#z", "unrelated words"), (3, None, "OTHER"), (4, "https://c.com", "nothing alike"), (5, None, None)],
        "id long, url string, title string",
    )
    assert rows(sessions.known_duplicates(new, known)) == [(1, 10, "title"), (2, 11, "url"), (3, 11, "title")]


def test_themes(spark):
    items = spark.createDataFrame([(1, "s", "Gold up", 1), (2, "s", "gold down", 3), (3, "s", "GOLD flat", None), (4, "s", None, 9), (5, "t", "gold", 9)], "item_id long, source string, text string, at int")
    themes = spark.createDataFrame([("metal", "s", ["Gold"]), ("none", "s", [])], "theme string, source string, keywords array<string>")
    assert rows(sessions.theme_items(items, themes, 2), "theme", "item_id") == [("metal", 1), ("metal", 2)]
    assert sessions.theme_items(items, themes, 0).count() == 3


def test_urls_and_publishing(spark):
    body = spark.createDataFrame([("see https://www.a.com/x/ and (https://github.com/i/1) https://a.com/x",), (None,)], "b string")
    assert [r.u for r in body.select(sessions.urls_in(F.col("b")).alias("u")).collect()] == [["https://a.com/x"], None]
    articles = spark.createDataFrame([("http://a/1", "s"), ("http://a/2", " "), ("http://a/3", "s")], "url string, summary string")
    done = spark.createDataFrame([("http://a/3/",), ("http://a/2",)], "url string")
    assert rows(sessions.publish_status(articles, done)) == [("http://a/1", "success"), ("http://a/2", "skipped"), ("http://a/3", "duplicate")]


def test_checks(spark):
    tasks = spark.createDataFrame([(1, "high", [2, 3, 9]), (2, "low", None), (3, "high", [])], "id long, priority string, depends_on array<long>")
    assert rows(sessions.priority_violations(tasks)) == [(1, 2), (1, 9)]
    presets = spark.createDataFrame([("http://a", "t", "c"), ("ftp://a", "", None), (None, "t", "c")], "url string, title string, category string")
    assert [r.errors for r in sessions.entry_errors(presets).collect()] == [[], ["url is not a web address", "title is missing", "category is missing"], ["url is missing"]]
    items = spark.createDataFrame([("reviewer", "checks code"), ("writer", "writes revews"), ("zzz", None)], "name string, description string")
    assert [r.name for r in sessions.fuzzy_search(items, "review", {"name": 2.0, "description": 1.0}, 0.25).collect()] == ["reviewer", "writer"]


def test_runs(spark):
    schema = "started_at timestamp, completed_at timestamp, sources map<string,struct<success_count:long,error_count:long,article_count:long>>"
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(at, at + dt.timedelta(seconds=10), {"a": (3, 1, 5), "b": (0, 0, 0)}), (at, at + dt.timedelta(seconds=20), {"a": (0, 0, 1)})], schema)
    assert tuple(sessions.run_statistics(df).first()) == (2, 3, 1, 6, 15.0, 0.75)
    assert tuple(sessions.run_statistics(df.limit(0)).first()) == (0, 0, 0, 0, 0.0, 1.0)
    assert rows(sessions.source_statistics(df)) == [("a", 3, 1, 6), ("b", 0, 0, 0)]


def test_dates(spark):
    now = F.to_timestamp(F.lit("2030-01-01"))
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05.123Z",), ("2024-01-02",), ("Jan 2, 2024",), ("bad",), (None,), ("2024年1月2日",), ("Tue, 02 Jan 2024 03:04:05 +0900",)], "t string"
    )
    got = lambda c: [str(r.v) for r in df.select(c.alias("v")).collect()]
    assert got(dates.parse_formats(F.col("t"), now))[:5] == ["2024-01-02 03:04:05", "2024-01-02 00:00:00", "2024-01-02 00:00:00", "2030-01-01 00:00:00", "2030-01-01 00:00:00"]
    assert got(dates.parse_japanese(F.col("t")))[3:] == ["None", "None", "2024-01-02 00:00:00", "2024-01-01 18:04:05"]
    local = spark.createDataFrame([("2024-01-02T09:00:00",), ("2024-01-02T09:00:00+00:00",)], "t string").select(dates.parse_local(F.col("t")).alias("v"))
    assert [str(r.v) for r in local.collect()] == ["2024-01-02 00:00:00", "2024-01-02 09:00:00"]
    zone = spark.createDataFrame([("2024-01-02T20:00:00Z",), ("later",)], "t string").select(dates.in_zone(F.col("t")).alias("v"))
    assert [r.v for r in zone.collect()] == ["2024-01-03 05:00", "later"]
    span = spark.createDataFrame([("2024-01-01T00:00:00Z", "2024-01-01T00:00:01.5Z"), ("x", None)], "a string, b string")
    assert [r.v for r in span.select(dates.duration_ms(F.col("a"), F.col("b")).alias("v")).collect()] == [1500, None]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "articles")
    first = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3)], "url string, pos int")
    assert rows(sinks.append_new(first, path, "url", ["pos"])) == [("u1", 1), ("u2", 3)]
    assert rows(sinks.append_new(spark.createDataFrame([("u2", 9), ("u3", 4)], first.schema), path, "url", ["pos"])) == [("u1", 1), ("u2", 3), ("u3", 4)]
    new = sinks.replace_index(spark.createDataFrame([("u1", 7)], first.schema), path, str(tmp_path / "v2"), "url")
    assert rows(new) == [("u1", 7), ("u2", 3), ("u3", 4)]
    days = spark.createDataFrame([("2024-01-01",), ("2024-03-01",), ("keep",)], "day string")
    assert rows(sinks.expired(days, "day", "2024-03-02", 30)) == [("2024-01-01",)]
    nodes, edges = spark.createDataFrame([("1", "A")], "id string, label string"), spark.createDataFrame([("1", "2", "T")], "src string, dst string, type string")
    sinks.write_documents(nodes, edges, str(tmp_path / "queue"), "news")
    assert rows(spark.read.json(str(tmp_path / "queue/command=news/nodes")), "id", "label") == [("1", "A")]


def test_files(spark, tmp_path):
    (tmp_path / "pdf/sub").mkdir(parents=True)
    (tmp_path / "pdf/a.pdf").write_bytes(b"one")
    (tmp_path / "pdf/sub/b.pdf").write_bytes(b"two")
    (tmp_path / "pdf/c.txt").write_bytes(b"three")
    found = files.hashed_files(spark, str(tmp_path / "pdf"))
    assert {(r.file.rsplit("/", 1)[1], r.sha256) for r in found.collect()} == {("a.pdf", hashlib.sha256(b"one").hexdigest()), ("b.pdf", hashlib.sha256(b"two").hexdigest())}
    (tmp_path / "md").mkdir()
    (tmp_path / "md/x.md").write_text("---\nurl: http://x\n---\n# A\ntext\n# B\n")
    (tmp_path / "md/y.md").write_text("no frontmatter")
    assert [(r.url, r.title, len(r.sections)) for r in files.markdown_sources(spark, str(tmp_path / "md")).collect()] == [("http://x", None, 2)]
    (tmp_path / "json/d").mkdir(parents=True)
    (tmp_path / "json/a.json").write_text(json.dumps({"news": [{"url": "u1", "title": "first"}, {"title": "no url"}, {"url": "u2", "title": "x"}]}))
    (tmp_path / "json/d/b.json").write_text(json.dumps({"news": [{"url": "u1", "title": "second"}]}))
    assert rows(files.raw_articles(spark, str(tmp_path / "json")), "url", "title") == [("u1", "first"), ("u2", "x")]
    config = spark.createDataFrame([('{"a": [{"symbol": "AAPL"}, {"b": {"symbol" : "MSFT"}}], "symbol": "AAPL"}',)], "c string")
    assert rows(files.symbols(config, "c")) == [("AAPL",), ("MSFT",)]
