"""Queries of the graph mappers: documents made of the tables, mapped to graphs.

A graph comes as rows (kind, a, type, b): nodes with label and name, edges with
the names of both ends, so that SQL can tell them without computing ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.plans import mappers
from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import discard, materialise

SITE = "https://news.example.com"


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


#: A table of doubtful names of no more bytes than this is broadcast; edges are
#: joined with a larger one by a shuffle.
BROADCAST_BYTES = 20_000_000
#: Chunks in a part of the extraction mapper's documents; a task holds their lookups.
CHUNKS = 100_000


def named(found: mappers.Graph) -> DataFrame:
    """Nodes and edges by their names."""
    nodes = found.node_rows.select(F.lit("node").alias("kind"), "label", "name").distinct().select("kind", F.lit(None).cast("string").alias("a"), F.col("label").alias("type"), F.col("name").alias("b"))
    edges = _named_at_rows(found) if "known" in found.edge_rows.columns else _named_by_joins(found)
    return nodes.unionByName(edges.select(F.lit("edge").alias("kind"), F.col("src_name").alias("a"), "type", F.col("dst_name").alias("b")))


def _names(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("id").agg(F.min("name").alias("name"))


def _named_by_joins(found: mappers.Graph) -> DataFrame:
    names = _names(found.node_rows)
    src, dst = (names.select(F.col("id").alias(end), F.col("name").alias(f"{end}_name")) for end in ("src", "dst"))
    return found.edges.join(src, "src").join(dst, "dst")


def _named_at_rows(found: mappers.Graph) -> DataFrame:
    """Edges by the names that their rows bring, told apart by the digest of their
    ids; only doubtful names are looked up."""
    edges, names = found.edge_rows, _doubtful_names(found)
    if names is None:
        edges = edges.where("known")
    else:
        size = names.agg(F.sum(F.octet_length("id") + F.coalesce(F.octet_length("name"), F.lit(0)))).first()[0] or 0
        for end in ("src", "dst"):
            at_end = names.select(F.col("id").alias(end), F.struct("name").alias("own"))
            edges = edges.join(F.broadcast(at_end) if size <= BROADCAST_BYTES else at_end, end, "left")
            edges = edges.withColumn(f"{end}_name", F.when(F.col("own").isNotNull(), F.col("own.name")).otherwise(F.col(f"{end}_name")))
            edges = edges.where(F.col("known") | F.col("own").isNotNull() if end == "dst" else F.lit(True)).drop("own")
    digest = F.unhex(F.md5(F.concat_ws("\0", "src", "dst", "type"))).alias("digest")
    return edges.where("once").select("src_name", "type", "dst_name").unionByName(edges.where("not once").select(digest, "src_name", "type", "dst_name").distinct().drop("digest"))


def _doubtful_names(found: mappers.Graph) -> DataFrame | None:
    """Names (id, name) of ids that rows name differently and of those nodes that an
    edge doesn't know to be one; None if there are none.

    Rows meet by a hash of the id; two ids that share one are looked up in vain.
    """
    at = lambda id_: F.xxhash64(id_).alias("at")
    nodes = found.node_rows.select(at("id"), F.xxhash64("name").alias("named"), F.lit(0).alias("asked"))
    ends = found.edge_rows.where("not known").select(at("dst"), F.lit(None).cast("long").alias("named"), F.lit(1).alias("asked"))
    several, asked = F.min("named") != F.max("named"), F.min("named").isNotNull() & (F.max("asked") > 0)
    doubts = materialise(nodes.unionByName(ends).groupBy("at").agg((several | asked).alias("doubt")).where("doubt").select("at"), "doubts")
    names = None
    if n := doubts.count():
        names = materialise(_names(found.node_rows.join(F.broadcast(doubts) if 8 * n <= BROADCAST_BYTES else doubts, at("id") == doubts["at"], "left_semi")), "names")
    discard(doubts)
    return names


def _sql(nodes: list[str], edges: list[str]) -> str:
    """nodes: SQL of type and b; edges: of a, type and b."""
    rows = [f"SELECT DISTINCT 'node' AS kind, NULL AS a, type, b FROM ({n})" for n in nodes]
    return " UNION ALL ".join(rows + [f"SELECT DISTINCT 'edge', a, type, b FROM ({e})" for e in edges])


_C = f"(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 > 0 THEN '{SITE}/c' || c_custkey END AS url, 'about ' || c_custkey AS title FROM customer WHERE c_custkey % 7 > 0)"


@query(_sql(
    [f"SELECT 'Entity' AS type, c_name AS b FROM {_C}", f"SELECT 'Source' AS type, title AS b FROM {_C} WHERE url IS NOT NULL"],
    [f"SELECT title AS a, 'ABOUT' AS type, c_name AS b FROM {_C} WHERE url IS NOT NULL"],
))
def mapped_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's customers as a batch of companies, some without name or URL."""
    key = F.col("c_custkey")
    company = F.struct(
        F.when(key % 7 > 0, F.col("c_name")).otherwise(" ").alias("company_name"), F.lit(None).cast("string").alias("ticker"),
        F.when(key % 3 > 0, _text(SITE, "/c", key)).alias("url"), _text("about ", key).alias("title"), F.lit(None).cast("string").alias("published"),
    )
    return named(mappers.map_companies(table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.collect_list(company).alias("companies")).select("companies")))


_S = "(SELECT DISTINCT n_nationkey, n_name, s_suppkey, s_name FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey)"


@query(_sql(
    ["SELECT 'Claim' AS type, 'on ' || n_name AS b FROM nation WHERE n_nationkey % 4 > 0", "SELECT 'Source' AS type, s_name AS b FROM supplier WHERE s_suppkey % 5 > 0"],
    [f"SELECT s_name AS a, 'MAKES_CLAIM' AS type, 'on ' || n_name AS b FROM {_S} WHERE s_suppkey % 5 > 0 AND n_nationkey % 4 > 0"],
))
def mapped_market_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as sections of reports, suppliers as their sources."""
    key = F.col("s_suppkey")
    source = F.struct(F.when(key % 5 > 0, _text(SITE, "/s", key)).otherwise("").alias("url"), F.col("s_name").alias("title"), F.lit(None).cast("string").alias("published"))
    sources = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_list(source).alias("sources"))
    n = table(spark, sf_dir, "nation").join(sources, "n_nationkey", "left")
    section = F.struct(F.col("n_name").alias("title"), F.when(F.col("n_nationkey") % 4 > 0, _text("on ", F.col("n_name"))).alias("content"), F.coalesce("sources", F.array().cast("array<struct<url:string,title:string,published:string>>")).alias("sources"))
    return named(mappers.map_market_report(n.groupBy("n_regionkey").agg(F.collect_list(section).alias("sections")).select("sections")))


@query(_sql(
    ["SELECT 'Topic' AS type, n_name AS b FROM nation", "SELECT 'Source' AS type, s_name AS b FROM supplier WHERE s_suppkey % 5 > 0"],
    [f"SELECT s_name AS a, 'TAGGED' AS type, n_name AS b FROM {_S} WHERE s_suppkey % 5 > 0"],
))
def mapped_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as themes, suppliers as their articles."""
    key = F.col("s_suppkey")
    article = F.struct(F.when(key % 5 > 0, _text(SITE, "/s", key)).alias("url"), F.col("s_name").alias("title"), F.lit(None).cast("string").alias("published"))
    return named(mappers.map_themes(_themes(spark, sf_dir, article, "name_ja")))


def _themes(spark: SparkSession, sf_dir: str, article: Column, name: str, *more: Column) -> DataFrame:
    """One document with a theme for every nation and an article for every supplier."""
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_list(article).alias("articles"))
    n = table(spark, sf_dir, "nation").join(s, "n_nationkey", "left")
    theme = F.struct(F.col("n_name").alias(name), *more, F.col("articles"))
    entry = F.struct(_text("k", F.col("n_nationkey")).alias("k"), theme.alias("v"))
    return n.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(entry)).alias("themes")).select("themes")


_O = f"(SELECT o_orderkey, 'topic ' || o_custkey AS topic, 'post ' || o_orderkey AS title, o_orderkey % 3 > 0 AS sourced FROM orders)"


@query(_sql(
    [f"SELECT 'Topic' AS type, topic AS b FROM {_O}", f"SELECT 'Source' AS type, title AS b FROM {_O} WHERE sourced"],
    [f"SELECT title AS a, 'TAGGED' AS type, topic AS b FROM {_O} WHERE sourced"],
))
def mapped_forum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts on topics."""
    key = F.col("o_orderkey")
    post = F.struct(_text("topic ", F.col("o_custkey")).alias("name"), F.when(key % 3 > 0, _text(SITE, "/o", key)).alias("url"), _text("post ", key).alias("title"), F.lit(None).cast("int").alias("score"))
    return named(mappers.map_forum(table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(post).alias("topics")).select("topics")))


_W = "(SELECT n_name, s_name, s_suppkey, s_suppkey % 3 AS host FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 5 > 0)"
_WEALTH = ["SELECT 'Topic' AS type, n_name AS b FROM nation", f"SELECT 'Source' AS type, s_name AS b FROM {_W}"]
_TAGGED = f"SELECT s_name AS a, 'TAGGED' AS type, n_name AS b FROM {_W} WHERE contains(s_name, '7')"


def _blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    article = F.struct(F.when(key % 5 > 0, _text(SITE, "/s", key)).alias("url"), F.col("s_name").alias("title"), _text("host", key % 3).alias("domain"), F.when(key % 2 == 0, _text("sum ", key)).otherwise("").alias("summary"))
    return _themes(spark, sf_dir, article, "name_en", F.array(F.lit("7"), F.lit("nothing like it")).alias("keywords_en"))


@query(_sql([*_WEALTH, f"SELECT 'Entity' AS type, 'host' || host AS b FROM {_W}"], [_TAGGED]))
def mapped_wealth_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blogs with their domains, tagged by keywords in titles."""
    return named(mappers.map_wealth_blogs(_blogs(spark, sf_dir), backfill=True))


@query(_sql(
    [*_WEALTH, f"SELECT 'Claim' AS type, 'sum ' || s_suppkey AS b FROM {_W} WHERE s_suppkey % 2 = 0"],
    [_TAGGED, f"SELECT s_name AS a, 'MAKES_CLAIM' AS type, 'sum ' || s_suppkey AS b FROM {_W} WHERE s_suppkey % 2 = 0"],
))
def mapped_wealth_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blogs with their summaries as claims."""
    return named(mappers.map_wealth_blogs(_blogs(spark, sf_dir), backfill=False))


_T = "(SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rank, o_orderpriority AS category, o_orderstatus AS symbol FROM orders)"
_SAID = "'idea ' || o_orderkey || ': because ' || o_custkey"


@query(_sql(
    [
        "SELECT 'Source' AS type, 'ts' || o_custkey AS b FROM orders", f"SELECT 'Topic' AS type, category AS b FROM {_T}", f"SELECT 'Claim' AS type, {_SAID} AS b FROM {_T}",
        f"SELECT 'Entity' AS type, CASE WHEN symbol = 'F' THEN '^F' ELSE symbol END AS b FROM {_T}", "SELECT 'Fact' AS type, 'finding ' || o_custkey || ' ' || j AS b FROM orders, range(2) t(j)",
    ],
    [
        f"SELECT 'ts' || o_custkey AS a, 'MAKES_CLAIM' AS type, {_SAID} AS b FROM {_T}", f"SELECT {_SAID} AS a, 'TAGGED' AS type, category AS b FROM {_T}",
        f"SELECT {_SAID} AS a, 'ABOUT' AS type, CASE WHEN symbol = 'F' THEN '^F' ELSE symbol END AS b FROM {_T}",
        "SELECT 'ts' || o_custkey AS a, 'STATES_FACT' AS type, 'finding ' || o_custkey || ' ' || j AS b FROM orders, range(2) t(j)",
    ],
))
def mapped_topic_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sessions that suggest a topic for every order."""
    key = F.col("o_orderkey")
    idea = F.struct(
        key.alias("at"), _text("idea ", key).alias("topic"), F.col("o_orderpriority").alias("category"), _text("because ", F.col("o_custkey")).alias("rationale"), F.lit(35).alias("total"),
        F.lit(None).cast("array<string>").alias("key_points"), F.array(F.when(F.col("o_orderstatus") == "F", "^F").otherwise(F.col("o_orderstatus"))).alias("suggested_symbols"),
    )
    d = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(idea)).alias("x"))
    suggestions = F.transform("x", lambda x, i: F.struct((i + 1).alias("rank"), *[x[c].alias(c) for c in ("topic", "category", "rationale", "total", "key_points", "suggested_symbols")]))
    findings = F.array(*[_text("finding ", F.col("o_custkey"), f" {j}") for j in range(2)])
    sessions = d.select(_text("ts", F.col("o_custkey")).alias("session_id"), suggestions.alias("suggestions"), F.array(F.struct(F.lit("q").alias("query"), findings.alias("key_findings"))).alias("trends"))
    return named(mappers.map_topic_discovery(sessions))


_R = "(SELECT s_nationkey, s_suppkey, s_name FROM supplier)"


@query(_sql(
    [f"SELECT 'Source' AS type, s_name AS b FROM {_R}", "SELECT 'Topic' AS type, n_name AS b FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)", f"SELECT 'Fact' AS type, 'fact ' || s_suppkey AS b FROM {_R} WHERE s_suppkey % 2 = 0"],
    [
        f"SELECT s_name AS a, 'TAGGED' AS type, n_name AS b FROM {_R} JOIN nation ON n_nationkey = s_nationkey",
        f"SELECT 'fact ' || s_suppkey AS a, 'TAGGED' AS type, n_name AS b FROM {_R} JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 2 = 0",
        f"SELECT s_name AS a, 'STATES_FACT' AS type, 'fact ' || s_suppkey AS b FROM {_R} WHERE s_suppkey % 2 = 0",
    ],
))
def mapped_web_research(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as research sessions; facts of unknown sources are dropped."""
    key = F.col("s_suppkey")
    address = _text(SITE, "/s", key)
    source = F.struct(address.alias("url"), F.col("s_name").alias("title"), F.when(key % 2 == 0, "media").otherwise("blog").alias("authority_level"))
    fact = F.struct(_text("fact ", key).alias("content"), F.when(key % 2 == 0, address).otherwise("https://unknown.example.org").alias("source_url"))
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_list(source).alias("sources"), F.collect_list(fact).alias("facts"))
    topics = F.array(F.struct(F.col("n_name").alias("name"), F.lit("geo").alias("category")))
    return named(mappers.map_web_research(s.join(table(spark, sf_dir, "nation"), "n_nationkey").select(F.col("n_nationkey").cast("string").alias("session_id"), "sources", topics.alias("topics"), "facts")))


_P = "(SELECT o_orderkey, 'paper ' || o_orderkey AS title, 'author ' || o_custkey AS one, 'author ' || (o_custkey + 1) % 100 AS two, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))"


@query(_sql(
    [f"SELECT 'Source' AS type, title AS b FROM {_P}", f"SELECT 'Author' AS type, one AS b FROM {_P} UNION SELECT 'Author', two FROM {_P}"],
    [
        f"SELECT title AS a, 'AUTHORED_BY' AS type, one AS b FROM {_P} UNION SELECT title, 'AUTHORED_BY', two FROM {_P}", f"SELECT title AS a, 'CITES' AS type, 'paper ' || before AS b FROM {_P} WHERE before IS NOT NULL",
        f"SELECT title AS a, 'CITES' AS type, 'paper ' || after AS b FROM {_P} WHERE after % 10 = 0",
    ],
))
def mapped_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as papers of two authors that cite each other in order; a citation
    of a later paper needs it to exist already.  Co-authors have a query of their own."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    author = lambda n: F.struct(_text("author ", n).alias("name"), F.lit(None).cast("string").alias("organization"))
    cited = F.array(*[F.struct(c.cast("string").alias("arxiv_id")) for c in (F.lag("o_orderkey").over(w), F.lead("o_orderkey").over(w))])
    papers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("arxiv_id"), _text("paper ", F.col("o_orderkey")).alias("title"),
        F.array(author(F.col("o_custkey")), author((F.col("o_custkey") + 1) % 100)).alias("authors"), cited.alias("references"),
    )
    existing = table(spark, sf_dir, "orders").where("o_orderkey % 10 = 0").select(F.col("o_orderkey").cast("string").alias("id"))
    return named(mappers.map_papers(papers, existing)).where("type <> 'COAUTHORED_WITH'")


@query("""
WITH a AS (SELECT o_orderkey AS g, 'author ' || o_custkey AS name FROM orders UNION SELECT o_orderkey, 'author ' || (o_custkey + 1) % 100 FROM orders)
SELECT DISTINCT least(x.name, y.name) AS a, greatest(x.name, y.name) AS b FROM a x JOIN a y ON x.g = y.g AND x.name <> y.name""")
def mapped_coauthors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of one paper; ids decide the direction of the edge, names here."""
    author = lambda n: F.struct(_text("author ", n).alias("name"), F.lit(None).cast("string").alias("organization"))
    papers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("arxiv_id"), F.lit("t").alias("title"),
        F.array(author(F.col("o_custkey")), author((F.col("o_custkey") + 1) % 100)).alias("authors"), F.array().cast("array<struct<arxiv_id:string>>").alias("references"),
    )
    found = named(mappers.map_papers(papers, papers.select(F.col("arxiv_id").alias("id")))).where("type = 'COAUTHORED_WITH'")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


_K = "(SELECT p_partkey, 'tip ' || p_partkey AS content, p_brand AS topic, p_type AS entity FROM part WHERE p_partkey % 6 > 0)"


@query(_sql(
    [f"SELECT 'Content' AS type, content AS b FROM {_K}", f"SELECT 'Topic' AS type, topic AS b FROM {_K}", f"SELECT 'Entity' AS type, entity AS b FROM {_K} WHERE p_partkey % 4 > 0"],
    [
        f"SELECT content AS a, 'ABOUT' AS type, topic AS b FROM {_K}", f"SELECT content AS a, 'MENTIONS' AS type, entity AS b FROM {_K} WHERE p_partkey % 4 > 0",
        "SELECT 'ECONOMY' AS a, 'RELATES_TO' AS type, 'PROMO' AS b",
    ],
))
def mapped_creator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as contents of a genre; entities of other kinds are dropped, and
    relations with an unknown end."""
    key = F.col("p_partkey")
    entity = F.struct(F.col("p_type").alias("name"), F.when(key % 4 > 0, " Brand ").otherwise("person").alias("entity_type"))
    content = F.struct(F.lit("tip").alias("kind"), F.when(key % 6 > 0, _text("tip ", key)).otherwise("").alias("content"), F.col("p_brand").alias("topic"), F.array(entity).alias("about_entities"))
    relations = F.array(*[F.struct(F.lit(a).alias("from_entity"), F.lit(b).alias("to_entity")) for a, b in (("ECONOMY::brand", "PROMO::brand"), ("ECONOMY::brand", "nothing::brand"))])
    d = table(spark, sf_dir, "part").groupBy((key % 10).alias("doc")).agg(F.collect_list(content).alias("contents"))
    return named(mappers.map_creator(d.select(F.lit("g1").alias("genre_id"), "contents", relations.alias("entity_relations")), ("brand",)))


_N = "(SELECT s_suppkey, s_name, s_nationkey, 'fact ' || s_suppkey AS fact FROM supplier)"


@query(_sql(
    [
        f"SELECT 'Source' AS type, 'src ' || s_suppkey AS b FROM {_N}", f"SELECT 'Domain' AS type, 'h' || s_suppkey % 3 || '.example.com' AS b FROM {_N}", f"SELECT 'Entity' AS type, s_name AS b FROM {_N}",
        "SELECT 'Concept' AS type, n_name AS b FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)", "SELECT 'ConceptCategory' AS type, 'even' AS b FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey IN (SELECT s_nationkey FROM supplier)",
        f"SELECT 'Content' AS type, fact AS b FROM {_N}", "SELECT 'Genre' AS type, 'g1' AS b",
    ],
    [
        f"SELECT 'src ' || s_suppkey AS a, 'FROM_DOMAIN' AS type, 'h' || s_suppkey % 3 || '.example.com' AS b FROM {_N}", "SELECT n_name AS a, 'IS_A' AS type, 'even' AS b FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey IN (SELECT s_nationkey FROM supplier)",
        f"SELECT fact AS a, 'ABOUT' AS type, n_name AS b FROM {_N} JOIN nation ON n_nationkey = s_nationkey", f"SELECT fact AS a, 'MENTIONS' AS type, s_name AS b FROM {_N}",
        f"SELECT fact AS a, 'FROM_SOURCE' AS type, 'src ' || s_suppkey AS b FROM {_N} WHERE s_suppkey % 2 = 0", f"SELECT fact AS a, 'IN_GENRE' AS type, 'g1' AS b FROM {_N}",
        f"SELECT s_name AS a, 'SERVES_AS' AS type, n_name AS b FROM {_N} JOIN nation ON n_nationkey = s_nationkey", f"SELECT n_name AS a, 'ENABLES' AS type, n_name AS b FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)",
    ],
))
def mapped_creator_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as documents of the second form, with concepts and domains."""
    key = F.col("s_suppkey")
    address = _text("https://www.H", key % 3, ".example.com/s", key)
    none = F.lit("nothing like it")
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.collect_list(F.struct(address.alias("url"), _text("src ", key).alias("title"))).alias("sources"),
        F.collect_list(F.struct(F.col("s_name").alias("name"), F.lit("Company").alias("entity_type"))).alias("entities"),
        F.collect_list(F.struct("s_suppkey", "s_name", address.alias("url"))).alias("x"),
    )
    d = s.join(table(spark, sf_dir, "nation"), "n_nationkey")
    nation = F.col("n_name")
    contents = F.transform("x", lambda x: F.struct(
        F.lit("Fact").alias("kind"), F.concat(F.lit("fact "), x["s_suppkey"].cast("string")).alias("content"), F.when(x["s_suppkey"] % 2 == 0, x["url"]).otherwise("").alias("source_url"),
        F.array(nation, none).alias("about_concepts"), F.array(x["s_name"], none).alias("about_entities"),
    ))
    serves = F.transform("x", lambda x: F.struct(x["s_name"].alias("entity_name"), nation.alias("concept_name")))
    concepts = F.array(F.struct(nation.alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "even").otherwise("odd").alias("category")))
    relations = F.array(*[F.struct(nation.alias("from_concept"), to.alias("to_concept"), F.lit(kind).alias("rel_type")) for to, kind in ((nation, "ENABLES"), (none, "ENABLES"), (nation, "LIKES"))])
    documents = d.select(
        F.col("n_nationkey").alias("doc"), F.lit("g1").alias("genre_id"), "sources", "entities", concepts.alias("concepts"), contents.alias("contents"), serves.alias("serves_as"), relations.alias("concept_relations")
    )
    return named(mappers.map_creator_concepts(documents, ("company",), {"even": "what"}))


_X = "(SELECT o_orderkey AS k, 'doc ' || o_custkey AS doc, 'part ' || o_orderkey AS part, 'e ' || o_custkey AS entity, 'fact ' || o_orderkey AS fact, 'claim ' || o_orderkey AS claim, o_orderkey % 2 = 0 AS even FROM orders)"


@query(_sql(
    [
        f"SELECT 'Source' AS type, doc AS b FROM {_X}", f"SELECT 'Chunk' AS type, part AS b FROM {_X}", f"SELECT 'Entity' AS type, entity AS b FROM {_X}", f"SELECT 'Fact' AS type, fact AS b FROM {_X}",
        f"SELECT 'Claim' AS type, claim AS b FROM {_X} WHERE even", f"SELECT 'Question' AS type, 'why ' || k AS b FROM {_X} WHERE even", f"SELECT 'FinancialDataPoint' AS type, 'metric ' || k AS b FROM {_X}",
        f"SELECT 'FiscalPeriod' AS type, 'FY' || k AS b FROM {_X}", f"SELECT 'Stance' AS type, 'r' || k AS b FROM {_X}", f"SELECT 'Author' AS type, 'a ' || k AS b FROM {_X}",
    ],
    [
        f"SELECT doc AS a, 'CONTAINS_CHUNK' AS type, part AS b FROM {_X}", f"SELECT doc AS a, 'STATES_FACT' AS type, fact AS b FROM {_X}", f"SELECT fact AS a, 'EXTRACTED_FROM' AS type, part AS b FROM {_X}",
        f"SELECT fact AS a, 'RELATES_TO' AS type, entity AS b FROM {_X}", f"SELECT doc AS a, 'MAKES_CLAIM' AS type, claim AS b FROM {_X} WHERE even", f"SELECT claim AS a, 'EXTRACTED_FROM' AS type, part AS b FROM {_X} WHERE even",
        f"SELECT claim AS a, 'ABOUT' AS type, entity AS b FROM {_X} WHERE even", f"SELECT doc AS a, 'HAS_DATAPOINT' AS type, 'metric ' || k AS b FROM {_X}", f"SELECT 'metric ' || k AS a, 'RELATES_TO' AS type, entity AS b FROM {_X}",
        f"SELECT 'metric ' || k AS a, 'FOR_PERIOD' AS type, 'FY' || k AS b FROM {_X}", f"SELECT 'a ' || k AS a, 'HOLDS_STANCE' AS type, 'r' || k AS b FROM {_X}", f"SELECT 'r' || k AS a, 'ON_ENTITY' AS type, entity AS b FROM {_X}",
        f"SELECT 'r' || k AS a, 'BASED_ON' AS type, claim AS b FROM {_X} WHERE even", f"SELECT doc AS a, 'RAISES_QUESTION' AS type, 'why ' || k AS b FROM {_X} WHERE even", f"SELECT 'why ' || k AS a, 'ASKS_ABOUT' AS type, entity AS b FROM {_X} WHERE even",
        f"SELECT 'why ' || k AS a, 'MOTIVATED_BY' AS type, fact AS b FROM {_X} WHERE even", f"SELECT fact AS a, 'CAUSES' AS type, claim AS b FROM {_X} WHERE even",
    ],
))
def mapped_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as documents with an order a chunk: entities, facts, claims, data
    points, stances, questions and what causes what."""
    key, name = F.col("o_orderkey"), _text("e ", F.col("o_custkey"))
    about = F.array(name, F.lit("nothing like it")).alias("about_entities")
    fact, claim = _text("fact ", key), _text("claim ", key)
    even = key % 2 == 0
    s = lambda **fields: F.struct(*[v.alias(k) for k, v in fields.items()])
    none = F.lit(None).cast("string")
    only = lambda item: F.when(even, F.array(item))
    chunk = s(
        chunk_index=key, section_title=_text("part ", key), content=none, entities=F.array(s(name=name, entity_type=F.lit("Company"), ticker=name)),
        facts=F.array(F.struct(fact.alias("content"), F.lit("x").alias("fact_type"), none.alias("as_of_date"), about)),
        claims=only(F.struct(claim.alias("content"), F.lit("x").alias("claim_type"), none.alias("sentiment"), about)),
        financial_datapoints=F.array(F.struct(_text("metric ", key).alias("metric_name"), F.lit(1.0).alias("value"), _text("FY", key).alias("period_label"), F.array(name).alias("about_entities"))),
        stances=F.array(s(author_name=_text("a ", key), author_type=F.lit("bank"), entity_name=name, rating=_text("r", key), as_of_date=none, based_on_claims=F.array(claim))),
        causal_links=only(s(from_type=F.lit("fact"), from_content=fact, to_type=F.lit("claim"), to_content=claim)),
        questions=only(F.struct(_text("why ", key).alias("content"), none.alias("priority"), about, F.array(fact).alias("motivated_by_contents"))),
    )
    # Keys meet before chunks are made of them, since chunks are much longer.
    orders = table(spark, sf_dir, "orders")
    parts = max(orders.count() // CHUNKS, spark.sparkContext.defaultParallelism)
    o = orders.select(_text("hash", F.col("o_custkey")).alias("source_hash"), "o_custkey", "o_orderkey").repartition(parts, "source_hash")
    d = o.groupBy("source_hash").agg(F.min(_text("doc ", F.col("o_custkey"))).alias("publisher"), F.collect_list(chunk).alias("chunks"))
    return named(mappers.map_extraction(d, parts))


@query("""
WITH s AS (SELECT o_orderkey AS id, o_custkey, o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN DATE '0001-01-01' ELSE CAST(o_orderdate AS DATE) END AS day FROM orders)
SELECT src, dst FROM (SELECT id AS src, lag(id) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY day, id) AS dst FROM s) WHERE dst IS NOT NULL""")
def superseded_stances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stances and those that they supersede; a bad date is the oldest."""
    o = table(spark, sf_dir, "orders")
    stances = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("author"), F.col("o_orderpriority").alias("entity"), F.when(F.col("o_orderkey") % 5 == 0, "some day").otherwise(F.to_date("o_orderdate").cast("string")).alias("as_of_date"))
    return mappers.stance_chain(stances).select("src", "dst")
