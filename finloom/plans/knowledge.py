"""Queries of claims, entities and stored graphs.

Orders serve as claims, parts and suppliers as entities, customers as sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators import claims, graph, reports
from finloom.plans.catalog import query
from finloom.plans.graph import _EDGES, _TRADE_NATIONS, _TRADERS, _TRADES, _trades, foreign_key_graph
from finloom.session import table

_RATINGS = ("Buy", "Hold", "Sell", "Strong")


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _rating(n: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, r in enumerate(_RATINGS):
        out = F.when(n % 5 == i, r).otherwise(out)
    return out


_RATING_SQL = "CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(_RATINGS)) + " END"


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    said = F.when(key % 3 < 2, _text("Bank ", F.chr(65 + F.col("o_custkey") % 26), " rates it")).otherwise("it is rated")
    made = o.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("src"), key.alias("dst"))
    found = o.select(key.alias("claim_id"), _rating(key).alias("rating"), F.when(key % 7 == 0, F.col("o_totalprice")).alias("target_price"), said.alias("content"))
    about = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()
    entities = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("name"))
    return claims.rated_claims(found, about, entities, made)


_RATED_SQL = f"""SELECT o_orderkey AS claim_id, {_RATING_SQL} AS rating, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice END AS target_price,
  CASE WHEN o_orderkey % 3 < 2 THEN 'Bank ' || chr(CAST(65 + o_custkey % 26 AS INTEGER)) END AS analyst, s_suppkey AS entity_id, s_name AS entity_name,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS source_id
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) l ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
WHERE o_orderkey % 5 < 4 OR o_orderkey % 7 = 0"""


@query(f"SELECT claim_id, rating, target_price, analyst, entity_id, entity_name, source_id FROM ({_RATED_SQL})")
def rated_claim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with a rating or a price, their analyst, entities and sources."""
    found = _rated(spark, sf_dir)
    return found.select("claim_id", "rating", "target_price", claims.analyst_name(F.col("content")).alias("analyst"), "entity_id", "entity_name", "source_id")


@query(f"""
WITH k AS (SELECT * FROM ({_RATED_SQL}) WHERE analyst IS NOT NULL AND entity_id IS NOT NULL)
SELECT DISTINCT analyst AS author, entity_name AS entity, rating, target_price,
  CASE rating WHEN 'Buy' THEN 'bullish' WHEN 'Sell' THEN 'bearish' ELSE 'neutral' END AS sentiment FROM k""")
def stances_from_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stances of analysts on entities by their rated claims."""
    return claims.stance_backfill(_rated(spark, sf_dir))[1].select("author", "entity", "rating", "target_price", "sentiment")


@query(f"""
WITH k AS (SELECT * FROM ({_RATED_SQL}) WHERE analyst IS NOT NULL AND entity_id IS NOT NULL)
SELECT 'HOLDS_STANCE' AS type, count(DISTINCT (analyst, entity_name)) AS n FROM k UNION ALL SELECT 'ON_ENTITY', count(DISTINCT (analyst, entity_name)) FROM k
UNION ALL SELECT 'BASED_ON', count(DISTINCT (analyst, entity_name, claim_id)) FROM k UNION ALL SELECT 'AUTHORED_BY', count(DISTINCT (source_id, analyst)) FROM k WHERE source_id IS NOT NULL
UNION ALL SELECT 'author', count(DISTINCT analyst) FROM k""")
def stance_edge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of each kind, and authors, that the stances bring."""
    authors, _, edges = claims.stance_backfill(_rated(spark, sf_dir))
    return edges.groupBy("type").agg(F.count("*").alias("n")).unionByName(authors.agg(F.count("*").alias("n")).withColumn("type", F.lit("author")))


@query("""
WITH m AS (SELECT o_orderkey AS claim_id, o_custkey AS src, o_orderdate AS collected_at FROM orders UNION ALL SELECT o_orderkey, (o_custkey + 1) % 100, o_orderdate - INTERVAL 1 DAY FROM orders),
s AS (SELECT claim_id, arg_max(c_name, (collected_at, src)) AS source_title, arg_max(c_mktsegment, (collected_at, src)) AS source_type FROM m JOIN customer ON src = c_custkey GROUP BY 1),
e AS (SELECT l_orderkey AS claim_id, string_agg(DISTINCT s_name, ',' ORDER BY s_name) AS entities FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
SELECT o_orderkey AS claim_id, source_title, source_type, coalesce(entities, '') AS entities FROM orders JOIN s ON s.claim_id = o_orderkey LEFT JOIN e ON e.claim_id = o_orderkey
WHERE o_orderstatus <> 'F'""")
def claims_awaiting_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims without a type, each with the source collected last and its entities."""
    o = table(spark, sf_dir, "orders")
    found = o.select(F.col("o_orderkey").alias("claim_id"), F.lit("c").alias("content"), F.when(F.col("o_orderstatus") == "F", "opinion").when(F.col("o_orderstatus") == "O", "analysis").alias("claim_type"))
    dated = o.select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"), F.col("o_orderdate").alias("at"))
    made = dated.unionByName(o.select(((F.col("o_custkey") + 1) % 100).alias("src"), F.col("o_orderkey").alias("dst"), (F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).alias("at")))
    customer = table(spark, sf_dir, "customer")
    # Every link has a source of its own here: a customer at a time of collection.
    sources = made.join(customer, F.col("src") == F.col("c_custkey")).select(
        F.struct("src", "dst").alias("source_id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("source_type"), F.col("at").alias("collected_at")
    )
    about = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"))
    entities = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("name"))
    linked = made.select(F.struct("src", "dst").alias("src"), "dst")
    out = claims.claims_to_classify(found, linked, sources.distinct(), about, entities, resume=True)
    return out.select("claim_id", "source_title", "source_type", F.array_join("entity_names", ",").alias("entities"))


@query("""
SELECT o_orderkey AS claim_id, CASE WHEN o_orderkey % 3 = 0 THEN 'type' || o_custkey % 4 ELSE 'analysis' END AS claim_type, CASE WHEN o_orderkey % 3 = 0 THEN 'bullish' END AS sentiment FROM orders""")
def claims_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims after the results of a classification, some of unknown claims."""
    o = table(spark, sf_dir, "orders")
    none = F.lit(None).cast("string")
    stored = o.select(F.col("o_orderkey").alias("claim_id"), F.lit("analysis").alias("claim_type"), none.alias("sentiment"), none.alias("magnitude"))
    results = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("claim_id"), _text("type", F.col("o_custkey") % 4).alias("claim_type"), F.lit("bullish").alias("sentiment"), F.lit("strong").alias("magnitude"))
    unknown = results.withColumn("claim_id", -1 - F.col("claim_id"))
    return claims.classified(stored, results.unionByName(unknown).unionByName(results)).select("claim_id", "claim_type", "sentiment")


@query("""
WITH f AS (SELECT 'F' || l_orderkey || '-' || l_linenumber AS id, 'Fact' AS label, l_orderkey, l_returnflag AS content FROM lineitem UNION ALL SELECT 'C' || o_orderkey, 'Claim', o_orderkey, o_orderpriority FROM orders),
p AS (SELECT *, md5('20260301|' || label || '|' || id) AS h FROM f ORDER BY h, id LIMIT 40)
SELECT id, p.content, label, CASE WHEN label = 'Claim' OR l_orderkey % 2 = 0 THEN c_name END AS title FROM p LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey""")
def sampled_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty facts and claims with their source, the same on the same day: a sample."""
    line, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    fact = _text("F", F.col("l_orderkey"), "-", F.col("l_linenumber"))
    facts = line.select(fact.alias("id"), F.col("l_returnflag").alias("content"))
    found = o.select(_text("C", F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("content"))
    chunk = lambda c: _text("chunk", F.col(c))
    stated = line.where("l_orderkey % 2 = 0").select(chunk("l_orderkey").alias("src"), fact.alias("dst")).unionByName(o.select(chunk("o_orderkey").alias("src"), _text("C", F.col("o_orderkey")).alias("dst")))
    contained = o.select(F.col("o_custkey").alias("src"), chunk("o_orderkey").alias("dst"))
    sources = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("title"), F.lit(None).cast("string").alias("url"))
    return claims.sampled_facts(facts, found, stated, contained, sources, 40, "20260301").select("id", "content", "label", "title")


@query("""
WITH f AS (SELECT l_suppkey AS id, count(*) FILTER (l_returnflag <> 'R') AS n_facts FROM lineitem GROUP BY 1),
t AS (SELECT l_suppkey AS id, l_returnflag AS x FROM lineitem WHERE l_returnflag <> 'R'),
l AS (SELECT id, string_agg(x, ',' ORDER BY x) AS facts FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY x) AS i FROM t) WHERE i <= 3 GROUP BY 1),
d AS (SELECT l_suppkey AS id, count(*) AS n FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1)
SELECT s_suppkey AS id, coalesce(f.n_facts, 0) AS n_facts, coalesce(l.facts, '') AS facts, coalesce(d.n, 0) AS n_datapoints, 0 AS n_claims
FROM supplier LEFT JOIN f ON f.id = s_suppkey LEFT JOIN l ON l.id = s_suppkey LEFT JOIN d ON d.id = s_suppkey""")
def entity_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts, data points and claims of every supplier in one pass each."""
    line = table(spark, sf_dir, "lineitem").withColumn("id", _text(F.col("l_orderkey"), "-", F.col("l_linenumber"), "-", F.col("l_partkey")))
    line = line.withColumn("id", F.struct("id", F.xxhash64("l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_suppkey").alias("h")).cast("string"))
    related = line.select(F.col("id").alias("src"), F.col("l_suppkey").alias("dst"))
    facts = line.select("id", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).otherwise("").alias("content"))
    points = line.where("l_linenumber % 2 = 0").select("id", F.lit("price").alias("metric_name"), F.col("l_extendedprice").alias("value"))
    entities = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    out = claims.entity_context(entities, related, facts, points, facts.where(F.lit(False)), most=3)
    return out.select("id", "n_facts", F.coalesce(F.array_join("facts", ","), F.lit("")).alias("facts"), "n_datapoints", F.col("n_claims").cast("int").alias("n_claims"))


@query("""
WITH e AS (SELECT s_suppkey AS node, 'n' || s_nationkey AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'company' ELSE '' END AS kind, s_suppkey % 4 = 3 AS has FROM supplier),
k AS (SELECT *, name || '::' || CASE WHEN kind = '' THEN 'unknown' ELSE kind END AS key FROM e),
f AS (SELECT key, min(node) AS node FROM k WHERE NOT has AND key NOT IN (SELECT key FROM k WHERE has) GROUP BY 1)
SELECT k.node, f.node IS NOT NULL AS fixed, CASE WHEN has OR f.node IS NOT NULL THEN k.key END AS entity_key FROM k LEFT JOIN f ON f.node = k.node""")
def missing_entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities without an id take one unless their key is another's."""
    key = F.col("s_suppkey")
    e = table(spark, sf_dir, "supplier").select(key.alias("node"), _text("n", F.col("s_nationkey")).alias("name"), F.when(key % 2 == 0, "company").otherwise("").alias("entity_type"), (key % 4 == 3).alias("has"))
    full = F.concat_ws("::", "name", F.coalesce(F.nullif("entity_type", F.lit("")), F.lit("unknown")))
    e = e.select("node", "name", "entity_type", F.when(F.col("has"), "old").alias("entity_id"), F.when(F.col("has"), full).alias("entity_key"))
    return claims.with_missing_ids(e).select("node", "fixed", "entity_key")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as nodes with labels."""
    key = F.col("p_partkey")
    labels = F.array_compact(F.array(F.when(key % 2 == 0, "Entity").otherwise("Fact"), F.when(key % 3 == 0, "Memory"), F.when(key % 5 == 0, "Archived")))
    return table(spark, sf_dir, "part").select(key.alias("id"), "p_name", labels.alias("labels"))


@query("SELECT p_partkey AS id, p_name FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0 AND p_partkey % 5 <> 0")
def exported_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of a label that are neither memory nor archived."""
    return claims.label_scan(_labelled(spark, sf_dir), "Entity").select("id", "p_name")


@query("SELECT DISTINCT l_partkey AS src, l_suppkey AS dst, p_name AS src_name, s_name AS dst_name FROM lineitem JOIN (SELECT p_partkey, p_name FROM part) ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey")
def exported_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with the names of both ends."""
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), _text("S", F.col("l_suppkey")).alias("dst")).distinct().withColumn("src", F.col("src").cast("string"))
    nodes = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"))
    nodes = nodes.unionByName(table(spark, sf_dir, "supplier").select(_text("S", F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name")))
    out = claims.edges_with_ends(edges, nodes, "name")
    return out.select(F.col("src").cast("long").alias("src"), F.substring("dst", 2, 20).cast("long").alias("dst"), "src_name", "dst_name")


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 3 = 0")
def contaminated_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with labels of two kinds that must stay apart."""
    return claims.contaminated(_labelled(spark, sf_dir), ("Memory",), ("Entity", "Fact")).select("id")


@query("SELECT s_suppkey AS entity_key, s_name AS name FROM supplier WHERE contains(s_name, '7')")
def entities_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities whose name contains a text."""
    return table(spark, sf_dir, "supplier").where(F.contains("s_name", F.lit("7"))).select(F.col("s_suppkey").alias("entity_key"), F.col("s_name").alias("name"))


@query("""
WITH o AS (SELECT o_custkey AS src, o_orderpriority AS dst, count(*) AS n, max(o_totalprice) AS top FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
c AS (SELECT o_custkey AS src, o_orderpriority AS dst, arg_max(o_totalprice, o_orderkey) AS top, CAST(-1 AS BIGINT) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2)
SELECT coalesce(o.src, c.src) AS src, coalesce(o.dst, c.dst) AS dst, coalesce(c.n, o.n) AS n, coalesce(c.top, o.top) AS top FROM o FULL JOIN c ON o.src = c.src AND o.dst = c.dst""")
def merged_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges after a merge of changes, the last of each."""
    o = table(spark, sf_dir, "orders").withColumn("type", F.lit("RATED"))
    ends = [F.col("o_custkey").alias("src"), F.col("o_orderpriority").alias("dst"), "type"]
    edges = o.where("o_orderstatus <> 'P'").groupBy(*ends).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    changes = o.where("o_orderstatus = 'P'").select(*ends, F.col("o_orderkey").alias("at"), F.lit(-1).cast("long").alias("n"), F.col("o_totalprice").alias("top"))
    return claims.merge_edges(edges, changes, ("at",)).select("src", "dst", "n", "top")


_KINDS = ("agents", "commands", "skills", "rules")


@query("""
WITH d AS (SELECT p_partkey AS k, ['agent', 'command', 'skill', 'rule'] AS kinds FROM part)
SELECT DISTINCT 'c' || k AS src, kinds[k % 4 + 1] || ':' || 'part-' || k % 50 AS dst FROM d UNION SELECT 'c' || k, 'skill:x' || k % 3 FROM d WHERE k % 2 = 0""")
def path_reference_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and those that their text names by path."""
    key = F.col("p_partkey")
    kinds = F.array(*map(F.lit, _KINDS))
    content = _text("see .claude/", F.get(kinds, (key % 4).cast("int")), "/part-", key % 50, ".md and .claude/agents/all-* ", F.when(key % 2 == 0, _text(".claude/skills/x", key % 3, " .claude/skills/x", key % 3)).otherwise(".claude/other/z"))
    return claims.path_references(table(spark, sf_dir, "part").select(_text("c", key).alias("id"), content.alias("content")))


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 3 = 0 AND p_type IN ('ECONOMY', 'PROMO') AND p_size > 10")
def shown_component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components by type, category and what a search found."""
    p = table(spark, sf_dir, "part")
    c = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 == 0, "agent").otherwise("skill").alias("type"), F.col("p_type").alias("category"))
    matched = p.where("p_size > 10").select(F.col("p_partkey").alias("id"))
    return claims.shown_components(c, ("agent", "skill"), ("ECONOMY", "PROMO"), matched).select("id")


@query("""
WITH e AS (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE l_quantity < 40 AND l_partkey <> 5)
SELECT 'part' AS kind, count(DISTINCT src) AS n FROM e UNION ALL SELECT 'supplier', count(DISTINCT dst) FROM e UNION ALL SELECT 'edge', count(*) FROM e""")
def drawn_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and edges that a drawing shows: unbroken edges of known nodes."""
    edges = table(spark, sf_dir, "lineitem").select(_text("P", F.col("l_partkey")).alias("src"), _text("S", F.col("l_suppkey")).alias("dst"), (F.col("l_quantity") >= 40).alias("broken")).distinct()
    nodes = table(spark, sf_dir, "part").where("p_partkey <> 5").select(_text("P", F.col("p_partkey")).alias("id"), F.lit("part").alias("kind"))
    nodes = nodes.unionByName(table(spark, sf_dir, "supplier").select(_text("S", F.col("s_suppkey")).alias("id"), F.lit("supplier").alias("kind")))
    shown, kept = claims.drawn(nodes, edges)
    return shown.groupBy("kind").agg(F.count("*").alias("n")).unionByName(kept.agg(F.count("*").alias("n")).select(F.lit("edge").alias("kind"), "n"))


@query("""
SELECT DISTINCT 'n' || s_nationkey AS src, 'n' || (s_suppkey % 25) AS dst FROM supplier WHERE s_nationkey <> s_suppkey % 25""")
def package_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages by the imports of their files."""
    key = F.col("s_suppkey")
    content = _text("import os\nfrom n", key % 25, ".core import x\n    import n", key % 25, "\n# import n1\nfrom . import y\n")
    files = table(spark, sf_dir, "supplier").select(_text("n", F.col("s_nationkey")).alias("package"), content.alias("content"))
    return claims.package_edges(files, tuple(f"n{i}" for i in range(25)))


def _whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return foreign_key_graph(spark, sf_dir)[1].unionByName(_trades(spark, sf_dir))


#: Steps within which pairs are looked for.
HOPS = 15
_PAIRS = f"""SELECT DISTINCT n.id AS a, concat('S', CAST(abs(hash_key) % 7 AS BIGINT)) AS b FROM (SELECT id, CAST(substr(id, 2) AS BIGINT) AS hash_key FROM ({_TRADERS}) WHERE id LIKE 'C%' UNION ALL SELECT 'X', 3) n"""


@query(f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst FROM ({_EDGES}) UNION SELECT src, dst FROM ({_TRADES})), g AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
p AS (SELECT concat('S', i) AS b, concat('S', i) AS id, 0 AS d FROM range(7) t(i) UNION SELECT p.b, g.dst, p.d + 1 FROM p JOIN g ON p.id = g.src WHERE p.d < 15),
m AS (SELECT b, id, min(d) AS distance FROM p GROUP BY 1, 2)
SELECT a, x.b, CAST(distance AS INTEGER) AS distance FROM ({_PAIRS}) x LEFT JOIN m ON m.b = x.b AND m.id = x.a""")
def pair_distance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps between every customer and one of seven suppliers, 15 at most; one pair has an unknown end."""
    key = F.substring("id", 2, 20).cast("long")
    pairs = table(spark, sf_dir, "customer").select(_text("C", F.col("c_custkey")).alias("id")).select(F.col("id").alias("a"), _text("S", key % 7).alias("b"))
    pairs = pairs.unionByName(spark.createDataFrame([("X", "S3")], "a string, b string"))
    return graph.pair_distances(_whole(spark, sf_dir), pairs, HOPS)


@query(f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst FROM ({_EDGES}) UNION SELECT src, dst FROM ({_TRADES})), g AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
p AS (SELECT concat('S', i) AS b, concat('S', i) AS id, 0 AS d FROM range(7) t(i) UNION SELECT p.b, g.dst, p.d + 1 FROM p JOIN g ON p.id = g.src WHERE p.d < 15),
m AS (SELECT b, id, min(d) AS distance FROM p GROUP BY 1, 2), r AS (SELECT a, x.b, distance FROM ({_PAIRS}) x LEFT JOIN m ON m.b = x.b AND m.id = x.a)
SELECT count(*) AS pairs, round(avg(distance), 2) AS mean_path, round(count(DISTINCT distance) / count(distance), 4) AS diversity, round(count(distance) / count(*), 4) AS reached FROM r""")
def discoverability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well pairs reach each other: mean path, kinds of distances, share reached."""
    return reports.discoverability(pair_distance_rows(spark, sf_dir))


# What a supplier depends on: one by its balance, and every third one also one by its nation.
_NEEDS = """SELECT s_suppkey AS src, CAST(floor(abs(s_acctbal)) AS BIGINT) % (SELECT count(*) FROM supplier) AS dst FROM supplier
  UNION SELECT s_suppkey, CAST(s_nationkey AS BIGINT) FROM supplier WHERE s_suppkey % 3 = 0"""


def _needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    one = suppliers.select(F.col("s_suppkey").alias("src"), (F.floor(F.abs("s_acctbal")).cast("long") % suppliers.count()).alias("dst"))
    return one.unionByName(suppliers.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("src"), F.col("s_nationkey").cast("long").alias("dst"))).distinct()


@query(f"""
WITH RECURSIVE e AS MATERIALIZED ({_NEEDS}), r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON r.dst = e.src)
SELECT a.src AS vertex, min(a.dst) AS component FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src GROUP BY 1""")
def dependency_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that depend on themselves in any number of steps, with their part."""
    return graph.cyclic_components(_needs(spark, sf_dir))


@query(f"""
WITH RECURSIVE e AS MATERIALIZED ({_NEEDS}), r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON r.dst = e.src),
c AS (SELECT DISTINCT min(a.dst) AS component FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src GROUP BY a.src),
w AS (SELECT component, component AS at_, 0 AS d FROM c UNION SELECT component, e.dst, d + 1 FROM w JOIN e ON e.src = at_ WHERE d < 200 AND NOT (d > 0 AND at_ = component)),
f AS (SELECT component, min(d) AS size FROM w WHERE d > 0 AND at_ = component GROUP BY 1)
SELECT component, CAST(size AS BIGINT) AS size, true AS closed FROM f""")
def dependency_cycle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shortest cycle of every part: its length, and whether its steps are dependencies."""
    needs = _needs(spark, sf_dir)
    cycle = graph.witness_cycles(needs, graph.cyclic_components(needs))
    sizes = cycle.groupBy("component").agg(F.count("*").alias("size"))
    steps = cycle.join(sizes, "component").select("component", "size", F.col("vertex").alias("src"), ((F.col("position") + 1) % F.col("size")).alias("position"))
    after = steps.join(cycle.select("component", F.col("position").cast("long").alias("position"), F.col("vertex").alias("dst")), ["component", "position"])
    known = needs.withColumn("known", F.lit(True))
    return after.join(known, ["src", "dst"], "left").groupBy("component", "size").agg(F.every(F.col("known").isNotNull()).alias("closed"))
