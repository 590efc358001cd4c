"""Nested documents as literal rows, and the graphs they give."""

from __future__ import annotations

import uuid

import pytest

from finloom.plans import mapped, mappers
from finloom.plans.mappers import Graph

EXTRACTION = (
    "source_hash string, publisher string, chunks array<struct<chunk_index:int,section_title:string,content:string,"
    "entities:array<struct<name:string,entity_type:string,ticker:string>>,"
    "facts:array<struct<content:string,fact_type:string,as_of_date:string,about_entities:array<string>>>,"
    "claims:array<struct<content:string,claim_type:string,sentiment:string,about_entities:array<string>>>,"
    "financial_datapoints:array<struct<metric_name:string,value:double,period_label:string,about_entities:array<string>>>,"
    "stances:array<struct<author_name:string,author_type:string,entity_name:string,rating:string,as_of_date:string,based_on_claims:array<string>>>,"
    "causal_links:array<struct<from_type:string,from_content:string,to_type:string,to_content:string>>,"
    "questions:array<struct<content:string,priority:string,about_entities:array<string>,motivated_by_contents:array<string>>>>>"
)


def u5(name: str) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def edges(g: Graph, kind: str) -> set:
    return {(r.src, r.dst) for r in g.edges.where(f"type = '{kind}'").collect()}


def labels(g: Graph) -> dict:
    return {r.label: r["count"] for r in g.nodes.groupBy("label").count().collect()}


def test_news(spark):
    schema = "articles array<struct<url:string,title:string,summary:string,published:string>>"
    rows = [([("http://a", "A", "says", None), ("http://a", "A", "says", None), ("http://b", "B", " ", "2024"), ("", "C", "x", None), (None, "D", "x", None)],), (None,), ([],)]
    g = mappers.map_news(spark.createDataFrame(rows, schema))
    assert labels(g) == {"Source": 2, "Claim": 1}
    assert {s for s, _ in edges(g, "MAKES_CLAIM")} == {u5("http://a")}


def test_companies_and_forum(spark):
    schema = "companies array<struct<company_name:string,ticker:string,url:string,title:string,summary:string,published:string>>"
    g = mappers.map_companies(spark.createDataFrame([([("Apple", "AAPL", "http://a", "t", None, None), ("Meta", None, "", "t", None, None), (" ", "X", "http://x", "t", None, None)],)], schema))
    assert labels(g) == {"Entity": 2, "Source": 1}
    assert edges(g, "ABOUT") == {(u5("http://a"), u5("entity:Apple:company"))}
    forum = mappers.map_forum(spark.createDataFrame([([("T", "http://t", "t", 3), ("T2", None, "t", None)],)], "topics array<struct<name:string,url:string,title:string,score:int>>"))
    assert labels(forum) == {"Topic": 2, "Source": 1}
    assert labels(g + forum) == {"Entity": 2, "Source": 2, "Topic": 2}


def test_market_report_keeps_the_first_title_of_a_url(spark):
    schema = "sections array<struct<title:string,content:string,sources:array<struct<url:string,title:string,published:string>>>>"
    rows = [([("one", "text", [("http://a", "first", None)]), ("two", None, [("http://a", "second", None), ("http://b", "b", None)])],)]
    g = mappers.map_market_report(spark.createDataFrame(rows, schema))
    assert {(r.label, r.name) for r in g.nodes.collect()} == {("Source", "first"), ("Source", "b"), ("Claim", "text")}
    assert {s for s, _ in edges(g, "MAKES_CLAIM")} == {u5("http://a")}


def test_themes(spark):
    schema = "themes map<string,struct<name_ja:string,articles:array<struct<url:string,title:string,published:string>>>>"
    g = mappers.map_themes(spark.createDataFrame([({"k": ("名", [("http://a", "t", None)]), "empty": ("空", [])},)], schema))
    assert labels(g) == {"Topic": 2, "Source": 1}
    assert edges(g, "TAGGED") == {(u5("http://a"), u5("topic:名:asset-management"))}


def test_extraction(spark):
    chunk = (
        0, "Intro", "text",
        [("Apple", "Company", "AAPL"), ("Apple", "company", "AAPL"), ("", "x", None)],
        [("sales rose", "metric", None, ["Apple", "Unknown"])],
        [("will grow", "forecast", "positive", ["Apple"])],
        [("revenue", 1.0, "FY2025", ["Apple"]), ("margin", None, None, None)],
        [("Ann", "analyst", "Apple", "Buy", "2025-01-01", ["will grow"]), ("", "analyst", "Apple", "Buy", None, None)],
        [("fact", "sales rose", "claim", "will grow"), ("fact", "missing", "claim", "will grow")],
        [("why?", "high", ["Apple"], ["sales rose"])],
    )
    empty = (1, None, None, None, None, None, None, None, None, None)
    g = mappers.map_extraction(spark.createDataFrame([("h", "bank", [chunk, empty]), ("h2", None, None)], EXTRACTION))
    assert labels(g) == {
        "Source": 2, "Chunk": 2, "Entity": 1, "Fact": 1, "Claim": 1, "FinancialDataPoint": 2, "FiscalPeriod": 1, "Stance": 1, "Author": 1, "Question": 1,
    }
    apple = u5("entity:Apple:company")
    assert edges(g, "CONTAINS_CHUNK") == {("h", "h_chunk_0"), ("h", "h_chunk_1")}
    assert {d for _, d in edges(g, "ABOUT") | edges(g, "ON_ENTITY") | edges(g, "ASKS_ABOUT")} == {apple}
    assert {d for _, d in edges(g, "FOR_PERIOD")} == {"AAPL_FY2025"}
    fact = next(r.id for r in g.nodes.where("label = 'Fact'").collect())
    claim = next(r.id for r in g.nodes.where("label = 'Claim'").collect())
    assert edges(g, "CAUSES") == {(fact, claim)}
    assert {d for _, d in edges(g, "MOTIVATED_BY")} == {fact}
    assert {d for _, d in edges(g, "BASED_ON")} == {claim}


def test_stance_chain(spark):
    rows = [("s1", "a", "e", "2024-01-01"), ("s2", "a", "e", "2025-01-01"), ("s3", "a", "e", "bad"), ("s4", "b", "e", None)]
    found = mappers.stance_chain(spark.createDataFrame(rows, "id string, author string, entity string, as_of_date string"))
    assert {(r.src, r.dst) for r in found.collect()} == {("s2", "s1"), ("s1", "s3")}


def test_papers(spark):
    schema = "pos long, arxiv_id string, title string, authors array<struct<name:string,organization:string>>, references array<struct<arxiv_id:string>>"
    rows = [
        (0, "p1", "one", [("Ann", None), ("Bob", "X")], [("p2",), ("old",)]),
        (1, "p2", "two", [("Ann", None), ("Ann", None)], [("p1",), ("unknown",)]),
        (2, "p3", "three", [(f"A{i}", None) for i in range(51)], None),
    ]
    g = mappers.map_papers(spark.createDataFrame(rows, schema), spark.createDataFrame([("old",)], "id string"))
    source = lambda x: u5(f"https://arxiv.org/abs/{x}")
    assert edges(g, "CITES") == {(source("p1"), source("old")), (source("p2"), source("p1"))}
    assert len(edges(g, "COAUTHORED_WITH")) == 1


def test_web_research(spark):
    schema = (
        "session_id string, sources array<struct<url:string,title:string,authority_level:string>>, "
        "topics array<struct<name:string,category:string>>, facts array<struct<content:string,source_url:string>>"
    )
    good = ("s", [("http://a", "t", "media")], [("T", "c"), ("U", "c")], [("f", "http://a"), ("g", "http://other")])
    g = mappers.map_web_research(spark.createDataFrame([good], schema))
    assert labels(g) == {"Source": 1, "Topic": 2, "Fact": 1}
    assert len(edges(g, "TAGGED")) == 4
    bad = ("s", [("http://a", "t", "rumour")], [], [])
    with pytest.raises(Exception, match="unknown authority: rumour"):
        mappers.map_web_research(spark.createDataFrame([bad], schema)).nodes.collect()


def test_topic_discovery(spark):
    schema = (
        "session_id string, suggestions array<struct<rank:int,topic:string,category:string,rationale:string,total:int,key_points:array<string>,suggested_symbols:array<string>>>, "
        "trends array<struct<query:string,key_findings:array<string>>>"
    )
    rows = [("s", [(1, "T", "etf", "why", 41, ["k"], ["^N225", "AAPL"]), (2, "U", "", None, None, None, ["AAPL"])], [("q", ["f0", "f1"]), ("r", None)]), ("t", None, None)]
    g = mappers.map_topic_discovery(spark.createDataFrame(rows, schema))
    assert labels(g) == {"Source": 2, "Topic": 1, "Claim": 2, "Entity": 2, "Fact": 2}
    assert edges(g, "ABOUT") == {("ts:s:rank1", "symbol:^N225"), ("ts:s:rank1", "symbol:AAPL"), ("ts:s:rank2", "symbol:AAPL")}
    assert edges(g, "STATES_FACT") == {("s", "trend:s:0:0"), ("s", "trend:s:0:1")}
    assert edges(g, "TAGGED") == {("ts:s:rank1", "content:etf")}
    claim = {r.id: r for r in g.nodes.where("label = 'Claim'").collect()}
    assert claim["ts:s:rank1"].name == "T: why" and '"magnitude":"strong"' in claim["ts:s:rank1"].props
    assert claim["ts:s:rank2"].name == "U" and '"key_points":"[]"' in claim["ts:s:rank2"].props


def test_wealth_blogs(spark):
    schema = "themes map<string,struct<name_en:string,keywords_en:array<string>,articles:array<struct<url:string,title:string,domain:string,summary:string>>>>"
    articles = [("http://a/1", "Index Funds", "a", "sum"), ("http://a/2", "Other", "a", ""), (None, "Index", "b", "x")]
    docs = spark.createDataFrame([({"k": ("Funds", ["index"], articles)},)], schema)
    back, new = mappers.map_wealth_blogs(docs, True), mappers.map_wealth_blogs(docs, False)
    assert labels(back) == {"Topic": 1, "Source": 2, "Entity": 1}
    assert labels(new) == {"Topic": 1, "Source": 2, "Claim": 1}
    assert edges(back, "TAGGED") == {(u5("http://a/1"), u5("topic:Funds:wealth-management"))}
    assert {s for s, _ in edges(new, "MAKES_CLAIM")} == {u5("http://a/1")}


def test_creator(spark):
    schema = (
        "genre_id string, contents array<struct<kind:string,content:string,topic:string,about_entities:array<struct<name:string,entity_type:string>>>>, "
        "entity_relations array<struct<from_entity:string,to_entity:string>>"
    )
    contents = [("fact", "F", "Side Job", [(" A ", "Person"), ("B", "alien")]), ("tip", "T", None, [("C", "company")]), ("story", " ", "x", None)]
    docs = spark.createDataFrame([("g", contents, [("A::person", "C::company"), ("A::person", "B::alien")])], schema)
    g = mappers.map_creator(docs, ("person", "company"))
    assert labels(g) == {"Content": 2, "Topic": 1, "Entity": 2}
    assert edges(g, "RELATES_TO") == {(u5("entity:A:person"), u5("entity:C:company"))}
    assert len(edges(g, "MENTIONS")) == 2


def test_creator_contents_of_close_digests(spark):
    """Two texts whose SHA-256 begin with the same eight digits."""
    schema = (
        "genre_id string, contents array<struct<kind:string,content:string,topic:string,about_entities:array<struct<name:string,entity_type:string>>>>, "
        "entity_relations array<struct<from_entity:string,to_entity:string>>"
    )
    contents = [("tip", f"tip {n}", "x", []) for n in (67268, 108999)]
    g = mappers.map_creator(spark.createDataFrame([("g", contents, [])], schema), ("person",))
    assert g.nodes.where("label = 'Content'").select("id").distinct().count() == 2
    assert len(edges(g, "ABOUT")) == 2


def test_creator_concepts_contents_of_close_digests(spark):
    """Two facts whose SHA-256 begin with the same eight digits."""
    schema = (
        "doc int, genre_id string, sources array<struct<url:string,title:string>>, entities array<struct<name:string,entity_type:string>>, concepts array<struct<name:string,category:string>>, "
        "contents array<struct<kind:string,content:string,source_url:string,about_concepts:array<string>,about_entities:array<string>>>, serves_as array<struct<entity_name:string,concept_name:string>>, "
        "concept_relations array<struct<from_concept:string,to_concept:string,rel_type:string>>"
    )
    contents = [("Fact", f"fact {n}", "", ["C"], []) for n in (21647, 31652)]
    g = mappers.map_creator_concepts(spark.createDataFrame([(1, "g", [], [], [("C", "")], contents, [], [])], schema), (), {})
    assert g.nodes.where("label = 'Content'").select("id").distinct().count() == 2
    assert len(edges(g, "ABOUT")) == 2


def test_edges_are_told_apart_once(spark):
    """Not in each kind of edge and again over all: every time is a shuffle of all edges."""
    plan = mappers.map_extraction(spark.createDataFrame([], EXTRACTION)).edges._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Aggregate [src#") for line in plan.splitlines()) <= 1


def chunk(at: int, **given) -> tuple:
    """A chunk of the extraction schema with the given fields."""
    fields = ("section_title", "content", "entities", "facts", "claims", "financial_datapoints", "stances", "causal_links", "questions")
    return (at, *[given.get(f) for f in fields])


def test_named_extraction_shuffles_edges_once(spark):
    """Neither lookups in a document nor the names of ends are joined."""
    chunks = [chunk(i, section_title=f"part {i}", entities=[("Apple", "Company", "AAPL")], facts=[(f"f{i}", "x", None, ["Apple"])]) for i in range(3)]
    found = mapped.named(mappers.map_extraction(spark.createDataFrame([("h", "bank", chunks)], EXTRACTION), 3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert "Join" not in plan
    assert not any("source_hash" in line for line in exchanges)
    assert sum("digest" in line for line in exchanges) == 1
    assert found.where("kind = 'edge'").count() == 3 * 4


@pytest.mark.parametrize("limit", [mapped.BROADCAST_BYTES, 0])
def test_named_extraction_of_ids_with_several_names(spark, monkeypatch, limit):
    """The least name that any row gives an id, as joins of all edges find it: titles
    and publishers that differ by row, ratings of one stance, a claim that another
    document makes, one that none does, and texts with the id of another kind."""
    monkeypatch.setattr(mapped, "BROADCAST_BYTES", limit)
    claims = [("will grow", "x", None, ["Apple", "Nobody"]), ("fact:f", "x", None, None)]
    first = [
        chunk(0, section_title="b", entities=[("Apple", "Company", "AAPL")], facts=[("f", "x", None, ["Apple"])], financial_datapoints=[("sales", 1.0, "FY1", ["Apple"]), ("sales", 1.0, "FY2", None)]),
        chunk(0, entities=[("Apple", "Fund", "Z")], claims=claims, causal_links=[("datapoint", "sales", "claim", "will grow"), ("fact", "f", "claim", "none")]),
        chunk(1, stances=[("Ann", "bank", "Apple", "Sell", None, ["will grow", "made elsewhere", "made nowhere", "fact:f"]), ("Ann", "bank", "Apple", "Buy", None, None)]),
    ]
    second = [
        chunk(0, section_title="c", claims=[("made elsewhere", "x", None, ["Apple"])], facts=[("made elsewhere", "x", None, None)], questions=[("why?", None, ["Apple"], ["made elsewhere", "f"])]),
        chunk(1, section_title="d", questions=[("why?", None, None, ["made elsewhere"])]),
    ]
    docs = [("h", "bank", first), ("h", "a bank", [chunk(2, section_title="e")]), ("g", None, second), ("g", "x", None), (None, "y", first), ("n", "z", None)]
    g = mappers.map_extraction(spark.createDataFrame(docs, EXTRACTION), 3)
    rows = lambda df: sorted((str(r.src_name), r.type, str(r.dst_name)) for r in df.collect())
    got = rows(mapped._named_at_rows(g))
    assert got == rows(mapped._named_by_joins(g))
    assert ("Buy", "BASED_ON", "made elsewhere") in got and ("Buy", "BASED_ON", "f") in got and not any("made nowhere" in r for r in got)
    assert ("a bank", "CONTAINS_CHUNK", "b") in got
    assert sum(kind == "CAUSES" for _, kind, _ in got) == 4  # two of each document that begins so


def test_named_extraction_looks_nothing_up_where_rows_agree(spark):
    chunks = [chunk(i, section_title=f"part {i}", stances=[("Ann", "bank", "Apple", "Buy", None, ["made nowhere"])], entities=[("Apple", "Company", None)]) for i in range(2)]
    assert mapped._doubtful_names(mappers.map_extraction(spark.createDataFrame([("h", "bank", chunks)], EXTRACTION), 2)) is None
