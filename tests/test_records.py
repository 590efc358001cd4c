"""Literal rows for record functions and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from finloom.functions import finance, records
from finloom.operators import reports


def one(df, column):
    return [r.v for r in df.select(column.alias("v")).collect()]


def test_records(spark):
    df = spark.createDataFrame([("a", None, " "), (None, "b", "c")], "x string, y string, z string")
    assert one(df, records.sparse_map({"x": F.col("x"), "y": F.col("y"), "z": F.col("z")})) == [{"x": "a"}, {"y": "b", "z": "c"}]
    nested = spark.createDataFrame([(1, (2, (3,)), [4])], "a int, b struct<c:int,d:struct<e:int>>, f array<int>")
    assert records.flattened(nested).columns == ["a", "b.c", "b.d.e", "f"]
    answers = spark.createDataFrame([(["long answer", " ", None, "x"],), ([],)], "a array<string>")
    assert one(answers, records.previews(F.col("a"), 4)) == [{"chat_answer_0_preview": "long", "chat_answer_3_preview": "x"}, {}]
    body = spark.createDataFrame([("depends_on: #3, Depends_on #12 and blocks #4",), (None,)], "b string")
    assert one(body, records.dependencies(F.col("b"), "depends_on")) == [[3, 12], None]
    keys = spark.createDataFrame([("https://docs.google.com/spreadsheets/d/Ab_1-x/edit#gid=0",), ("plain",)], "t string")
    assert one(keys, records.spreadsheet_key(F.col("t"))) == ["Ab_1-x", "plain"]
    tickers = spark.createDataFrame([(" aapl ",), ("^n225",), ("brk.b",), ("",), ("a b",), ("ABCDEFGHIJK",), (None,)], "t string")
    assert one(tickers, records.valid_ticker(F.col("t"))) == ["AAPL", "^N225", "BRK.B", None, None, None, None]
    status = spark.createDataFrame([(["done", "done"],), (["done", "pending"],), (["pending"],), ([],)], "s array<string>")
    assert one(status, records.best_status(F.col("s"))) == ["done", "in_progress", "pending", "pending"]
    names = spark.createDataFrame([("finance-x",), ("fin",), ("zzz",)], "n string")
    assert one(names, records.prefix_category(F.col("n"), (("finance-", "Finance"), ("fin", "Other")))) == ["Finance", "Other", "General"]
    attempts = spark.createDataFrame([(1,), (3,), (10,)], "n int")
    assert one(attempts, finance.backoff_seconds(F.col("n"))) == [1.0, 4.0, 60.0]


def test_blocks(spark):
    md = "# Head\n\ntext\n- item\n1. first\n> quote\n---\n![alt](x.png)\n| a | b |"
    found = one(spark.createDataFrame([(md,)], "b string"), records.blocks(F.col("b")))[0]
    assert [(x.kind, x.content) for x in found] == [
        ("heading", "Head"), ("paragraph", "text"), ("list", "item"), ("list", "first"), ("quote", "quote"), ("separator", "---"), ("image", "![alt](x.png)"), ("table", "| a | b |"),
    ]
    cells = spark.createDataFrame([(["1,000", "$5", "x", ""],), (["a", "1"],), (["a", "b", "1"],), ([],)], "c array<string>")
    assert one(cells, records.right_aligned(F.col("c"))) == [True, True, False, False]


def test_reports(spark):
    tasks = spark.createDataFrame([(1, 10, "done"), (2, 11, "todo"), (3, None, "todo"), (4, 99, "todo"), (5, 11, "done")], "id long, issue long, status string")
    issues = spark.createDataFrame([(10, "open"), (11, "closed")], "number long, state string")
    assert {(r.id, r.problem) for r in reports.status_mismatches(tasks, issues).collect()} == {
        (1, "done but open"), (2, "closed but not done"), (3, "no issue"), (4, "unknown issue"),
    }
    labels = spark.createDataFrame([("Source",), ("claim",), ("Odd",), ("Odd",)], "label string")
    assert {tuple(r) for r in reports.label_violations(labels, ["Source"]).collect()} == {("claim", "not in capitals"), ("Odd", "unknown")}
    facts, chunks = spark.createDataFrame([("f", "s"), ("g", "t")], "id string, source string"), spark.createDataFrame([("c2", "s"), ("c1", "s")], "id string, source string")
    links, made = reports.chunk_links(facts, chunks)
    assert {tuple(r) for r in links.collect()} == {("f", "c1"), ("g", "t_chunk_0")} and [tuple(r) for r in made.collect()] == [("t_chunk_0", "t")]
    layers = spark.createDataFrame([("a", "exact"), ("b", "fuzzy"), (None, "new")], "match string, layer string")
    assert tuple(reports.layered_counts(layers).first()) == (3, 2, 1, {"exact": 1, "fuzzy": 1, "new": 1})
    nodes = spark.createDataFrame([(f"n{i}",) for i in range(30)], "id string")
    pairs = [tuple(r) for r in reports.sample_pairs(nodes, 10).collect()]
    assert len(pairs) == 10 and len({x for p in pairs for x in p}) == 20
    assert sorted(pairs) == sorted(tuple(r) for r in reports.sample_pairs(nodes.repartition(5), 10).collect())
    assert [r.number for r in reports.numbered(nodes, ["id"]).orderBy("id").collect()] == list(range(1, 31))
