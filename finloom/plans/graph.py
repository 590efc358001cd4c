"""Graph, resolution and quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finloom.operators import graph, grouping, similarity
from finloom.plans.catalog import query
from finloom.session import table

_ID = {"region": ("R", "r_regionkey"), "nation": ("N", "n_nationkey"), "supplier": ("S", "s_suppkey"), "customer": ("C", "c_custkey")}
_FOREIGN = (("nation", "N", "n_nationkey", "R", "n_regionkey"), ("supplier", "S", "s_suppkey", "N", "s_nationkey"), ("customer", "C", "c_custkey", "N", "c_nationkey"))


def _key(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def foreign_key_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id) and edges (src, dst) of regions, nations, suppliers and customers."""
    nodes = reduce(DataFrame.unionByName, [table(spark, sf_dir, t).select(_key(p, c).alias("id")) for t, (p, c) in _ID.items()])
    edges = [table(spark, sf_dir, t).select(_key(p, c).alias("src"), _key(q, d).alias("dst")) for t, p, c, q, d in _FOREIGN]
    return nodes, reduce(DataFrame.unionByName, edges)


_NODES = " UNION ALL ".join(f"SELECT concat('{p}', {c}) AS id FROM {t}" for t, (p, c) in _ID.items())
_EDGES = " UNION ALL ".join(f"SELECT concat('{p}', {c}) AS src, concat('{q}', {d}) AS dst FROM {t}" for t, p, c, q, d in _FOREIGN)
_DEGREES = f"""SELECT n.id, count(e.id) AS degree FROM ({_NODES}) n LEFT JOIN (SELECT src AS id FROM ({_EDGES}) UNION ALL SELECT dst FROM ({_EDGES})) e USING (id) GROUP BY 1"""


@query(f"""
WITH d AS ({_DEGREES}), e AS (SELECT count(*) AS m FROM ({_EDGES}))
SELECT count(*) AS node_count, max(m) AS relationship_count, round(max(m) / (count(*) * (count(*) - 1)), 8) AS density, round(avg(degree), 4) AS avg_degree,
  round(avg(CASE WHEN degree = 0 THEN 1.0 ELSE 0.0 END), 4) AS orphan_node_ratio FROM d, e""")
def graph_structural_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.structural_metrics(*foreign_key_graph(spark, sf_dir))


@query(f"SELECT degree, count(*) AS n FROM ({_DEGREES}) GROUP BY 1")
def degree_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degrees(*foreign_key_graph(spark, sf_dir)).groupBy("degree").agg(F.count("*").alias("n"))


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of customers and the suppliers that they order from."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey").select(_key("C", "o_custkey").alias("src"), _key("S", "l_suppkey").alias("dst")).distinct()


_TRADES = "SELECT DISTINCT concat('C', o_custkey) AS src, concat('S', l_suppkey) AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_TRADERS = "SELECT concat('C', c_custkey) AS id FROM customer UNION ALL SELECT concat('S', s_suppkey) FROM supplier"


@query(f"""
WITH RECURSIVE t AS MATERIALIZED ({_TRADES}), b AS MATERIALIZED (SELECT src, dst FROM t UNION SELECT dst, src FROM t),
c(id, root) USING KEY (id) AS (SELECT id, id AS root FROM ({_TRADERS})
  UNION SELECT b.dst, min(c.root) FROM c JOIN b ON c.id = b.src JOIN recurring.c AS o ON o.id = b.dst WHERE c.root < o.root GROUP BY 1),
s AS (SELECT root, count(*) AS size FROM c GROUP BY 1)
SELECT count(*) AS n_components, max(size) AS largest, round(max(size) / sum(size), 4) AS ratio FROM s""")
def connected_component_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "customer").select(_key("C", "c_custkey").alias("id")).unionByName(table(spark, sf_dir, "supplier").select(_key("S", "s_suppkey").alias("id")))
    sizes = graph.component_sizes(nodes, _trades(spark, sf_dir))
    return sizes.agg(F.count("*").alias("n_components"), F.max("size").alias("largest"), F.round(F.max("size") / F.sum("size"), 4).alias("ratio"))


@query(f"""
WITH RECURSIVE e AS (SELECT src, dst FROM ({_EDGES}) UNION SELECT src, dst FROM ({_TRADES})), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
p AS (SELECT 'R0' AS id, 0 AS d UNION SELECT b.dst, p.d + 1 FROM p JOIN b ON p.id = b.src WHERE p.d < 4)
SELECT distance, count(*) AS n FROM (SELECT id, min(d) AS distance FROM p GROUP BY 1) GROUP BY 1""")
def shortest_paths_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by their distance from one region, four steps at most."""
    edges = foreign_key_graph(spark, sf_dir)[1].unionByName(_trades(spark, sf_dir))
    start = spark.createDataFrame([("R0",)], "id string")
    return graph.hop_distances(edges, start, 4).groupBy("distance").agg(F.count("*").alias("n"))


_TRADE_NATIONS = """SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey"""


@query(f"""
WITH e AS ({_TRADE_NATIONS})
SELECT CAST(e1.src AS BIGINT) AS a, CAST(e1.dst AS BIGINT) AS b, CAST(NULL AS BIGINT) AS c FROM e e1 JOIN e e2 ON e1.dst = e2.src AND e2.dst = e1.src WHERE e1.src < e1.dst
UNION ALL SELECT e1.src, e1.dst, e2.dst FROM e e1 JOIN e e2 ON e1.dst = e2.src JOIN e e3 ON e2.dst = e3.src AND e3.dst = e1.src WHERE e1.src < e1.dst AND e1.src < e2.dst""")
def cycle_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade cycles of two and three nations."""
    t = lambda name: table(spark, sf_dir, name)
    lines = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
    orders = t("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    joined = lines.join(orders, "o_orderkey").join(t("customer"), "c_custkey").join(t("supplier"), "s_suppkey")
    edges = joined.select(F.col("c_nationkey").cast("long").alias("src"), F.col("s_nationkey").cast("long").alias("dst")).distinct()
    return graph.short_cycles(edges)


@query("""
WITH m AS (SELECT DISTINCT l_suppkey AS item, l_partkey AS g FROM lineitem)
SELECT a.item AS a, b.item AS b, count(*) AS n_shared FROM m a JOIN m b ON a.g = b.g AND a.item < b.item GROUP BY 1, 2 HAVING count(*) >= 150""")
def cooccurrence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that share 150 parts or more."""
    members = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("item"), F.col("l_partkey").alias("group"))
    return graph.shared_members(members, 150).select("a", "b", "n_shared")


@query("""
WITH m AS (SELECT DISTINCT l_partkey AS item, l_orderkey AS g FROM lineitem), ok AS (SELECT g FROM m GROUP BY 1 HAVING count(*) <= 50), n AS (SELECT * FROM m SEMI JOIN ok USING (g))
SELECT a.item AS a, b.item AS b, count(*) AS n_shared, min(a.g) AS first_group FROM n a JOIN n b ON a.g = b.g AND a.item < b.item GROUP BY 1, 2 HAVING count(*) >= 2""")
def coauthor_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that two orders or more have in common; orders of over fifty parts don't count."""
    members = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("group"))
    return graph.shared_members(members, 2, most_members=50)


@query("""
WITH p AS (SELECT o_orderkey AS id, o_custkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
x AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'), c AS (SELECT id AS src, unnest([before, after]) AS dst FROM p)
SELECT DISTINCT src, dst FROM c WHERE dst IN (SELECT id FROM x) OR (dst < src AND dst IN (SELECT id FROM p))""")
def citation_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of what exists or was seen earlier: an order cites its customer's
    last and next one, finished orders exist."""
    orders = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    papers = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("pos"), F.array(F.lag("o_orderkey").over(w), F.lead("o_orderkey").over(w)).alias("cites"))
    return similarity.citations_in_order(papers, orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def isolated_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return graph.without_edges(nodes, urgent.select(F.col("o_custkey").alias("src"), F.col("o_custkey").alias("dst"))).select(F.col("id").alias("c_custkey"))


_ALIASES = (("brand#11", "m11", 0), ("brand#22", "m22", 1), ("brand#33", "m33", 2), ("Brand#22", "m22b", 3))


@query(f"""
WITH a AS (SELECT lower(alias) AS alias, arg_max(target, pos) AS target FROM (VALUES {', '.join(map(str, _ALIASES))}) t(alias, target, pos) GROUP BY 1)
SELECT n.name, a.target FROM (SELECT DISTINCT p_brand AS name FROM part) n LEFT JOIN a ON lower(n.name) = a.alias""")
def metric_alias_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with the measure that their alias stands for."""
    names = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct()
    return similarity.link_aliases(names, spark.createDataFrame(_ALIASES, "alias string, target string, pos int"))


def _words(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(F.split(F.lower(column), "[^a-z]+")).alias("name")).where(F.length("name") >= 5).distinct()


_WORDS = "SELECT DISTINCT name FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS name FROM {}) WHERE length(name) >= 5"


@query(f"""
WITH w AS ({_WORDS.format('benchmark')}), k AS (SELECT name AS match FROM ({_WORDS.format('conversations')})), rest AS (SELECT * FROM w ANTI JOIN k ON w.name = k.match),
c AS (SELECT name, match, 1 - levenshtein(name, match) / greatest(length(name), length(match)) AS s FROM rest JOIN k ON abs(length(name) - length(match)) <= 0.2 * greatest(length(name), length(match))),
f AS (SELECT name, arg_min(match, (-s, match)) AS match FROM c WHERE s > 0.8 + 1e-12 GROUP BY 1)
SELECT name, name AS match, 'exact' AS layer FROM w SEMI JOIN k ON w.name = k.match
UNION ALL SELECT name, f.match, CASE WHEN f.match IS NULL THEN 'new' ELSE 'fuzzy' END FROM rest LEFT JOIN f USING (name)""")
def entity_resolution_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of benchmark items among those of conversations: equal, similar or new."""
    return similarity.resolve_names(_words(table(spark, sf_dir, "benchmark"), "text"), _words(table(spark, sf_dir, "conversations"), "text"))


@query("""
WITH s AS (SELECT a.vec_id AS query, b.vec_id AS match, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query, arg_max(match, (s, -match)) AS match, round(max(s), 4) AS score FROM s GROUP BY 1 HAVING max(s) >= 0.3""")
def embedding_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest other vector of each queried one (ids divisible by 100, the stated queries)."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return similarity.best_matches(vectors, vectors.where("id % 100 = 0"), 0.3)


_FILLED = ("doc_id", "text", "lang", "source", "n_chars")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN trim(CAST({c} AS VARCHAR)) <> '' THEN 1.0 ELSE 0.0 END), 4) AS fill_rate FROM documents" for c in _FILLED))
def completeness_fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.fill_rates(table(spark, sf_dir, "documents"), _FILLED)


_DISTRIBUTIONS = (("events", "event_type"), ("documents", "lang"), ("customer", "c_mktsegment"), ("region", "r_name"))


def _entropy_sql(t: str, c: str) -> str:
    return f"""SELECT '{c}' AS distribution, CASE WHEN count(*) > 1 THEN round((log2(sum(n)) - sum(n * log2(n)) / sum(n)) / log2(count(*)), 4) ELSE 0.0 END AS entropy
  FROM (SELECT {c}, CAST(count(*) AS DOUBLE) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1)"""


@query(" UNION ALL ".join(_entropy_sql(t, c) for t, c in _DISTRIBUTIONS))
def shannon_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [grouping.entropy(table(spark, sf_dir, t), c, c) for t, c in _DISTRIBUTIONS])


def _snapshot(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    early = F.col("ts") < F.to_timestamp(F.lit("2024-01-16"))
    events = table(spark, sf_dir, "events").where(~early if late else early)
    return events.groupBy(F.col("event_type").alias("name")).agg(F.round(F.avg("value"), 6).alias("value"))


_SNAPSHOTS = """SELECT coalesce(b.name, a.name) AS name, coalesce(b.v, 0) AS before, coalesce(a.v, 0) AS after, round(coalesce(a.v, 0) - coalesce(b.v, 0), 4) AS change
  FROM (SELECT event_type AS name, round(avg(value), 6) AS v FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1) b
  FULL JOIN (SELECT event_type AS name, round(avg(value), 6) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1) a ON a.name = b.name"""


@query(_SNAPSHOTS)
def snapshot_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.compare_snapshots(_snapshot(spark, sf_dir, False), _snapshot(spark, sf_dir, True), "name", "value")


@query(f"""
WITH c AS ({_SNAPSHOTS}),
r AS (SELECT 'short_text' AS rule, round(1 - count(*) FILTER (length(text) < 500) / count(*), 4) AS pass_rate FROM documents),
o AS (SELECT count(*) AS n FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT'))
SELECT 'score_' || name AS name, CASE WHEN before - after >= 10 THEN 'critical' ELSE 'warning' END AS severity, after AS value FROM c WHERE before - after >= 5
UNION ALL SELECT 'rule_' || rule, 'warning', pass_rate FROM r WHERE pass_rate < 0.95
UNION ALL SELECT 'orphan_entities', CASE WHEN n >= 200 THEN 'critical' ELSE 'warning' END, CAST(n AS DOUBLE) FROM o WHERE n >= 50""")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = grouping.rule_result(table(spark, sf_dir, "documents"), "short_text", F.length("text") < 500)
    orphans = isolated_entities(spark, sf_dir).agg(F.count("*").alias("n"))
    return grouping.alerts(snapshot_compare(spark, sf_dir), rule, orphans)


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = graph_structural_metrics(spark, sf_dir)
    named = [(c, F.col(c).cast("double")) for c in ("node_count", "relationship_count", "density", "avg_degree", "orphan_node_ratio")]
    return facts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in named])))


_MEASURED = f"""SELECT metric, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (WITH d AS ({_DEGREES}), e AS (SELECT count(*) AS m FROM ({_EDGES}))
  SELECT CAST(count(*) AS DOUBLE) AS node_count, CAST(max(m) AS DOUBLE) AS relationship_count, round(max(m) / (count(*) * (count(*) - 1)), 8) AS density, round(avg(degree), 4) AS avg_degree,
  CAST(round(avg(CASE WHEN degree = 0 THEN 1.0 ELSE 0.0 END), 4) AS DOUBLE) AS orphan_node_ratio FROM d, e) ON COLUMNS(*) INTO NAME metric VALUE value)"""
_STATUS = "CASE metric " + " ".join(
    f"WHEN '{m}' THEN CASE WHEN value {'<=' if m in grouping.LESS_IS_BETTER else '>='} {g} THEN 'green' WHEN value {'<=' if m in grouping.LESS_IS_BETTER else '>='} {y} THEN 'yellow' ELSE 'red' END"
    for m, (g, y) in grouping.THRESHOLDS.items()
) + " ELSE 'yellow' END"


@query(f"SELECT metric, value, {_STATUS} AS status FROM ({_MEASURED})")
def quality_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(spark, sf_dir).select("metric", "value", grouping.metric_status(F.col("metric"), F.col("value")).alias("status"))


@query(f"""
WITH s AS (SELECT round(avg(CASE {_STATUS} WHEN 'green' THEN 100.0 WHEN 'yellow' THEN 50.0 ELSE 0.0 END), 1) AS score FROM ({_MEASURED}))
SELECT score, CASE WHEN score >= 80 THEN 'A' WHEN score >= 60 THEN 'B' WHEN score >= 40 THEN 'C' ELSE 'D' END AS grade FROM s""")
def quality_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = quality_status(spark, sf_dir).agg(F.round(F.avg(grouping.status_score(F.col("status"))), 1).alias("score"))
    return score.select("score", grouping.grade(F.col("score")).alias("grade"))


_CHECKS = (("license", "license", 3), ("number", "[0-9]{4}", 2), ("mail", "@", 1), ("french", r"\bque\b", 1))


@query(
    "SELECT source, CAST(" + " + ".join(f"c{i}" for i in range(len(_CHECKS))) + " AS BIGINT) AS satisfied, round(("
    + " + ".join(f"c{i} * {w}" for i, (*_, w) in enumerate(_CHECKS)) + f") / {sum(w for *_, w in _CHECKS)}.0, 4) AS score FROM (SELECT source, "
    + ", ".join(f"max(CASE WHEN regexp_matches(text, '(?i){p}') THEN 1 ELSE 0 END) AS c{i}" for i, (_, p, _w) in enumerate(_CHECKS)) + " FROM documents GROUP BY 1)"
)
def weighted_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the weighted checks that the documents of a source satisfy."""
    return grouping.weighted_completeness(table(spark, sf_dir, "documents"), "source", "text", _CHECKS)


@query(f"""
WITH e AS (SELECT src, dst, 'trades' AS type FROM ({_TRADES}) UNION ALL SELECT src, dst, 'part_of' FROM ({_EDGES})), n AS ({_TRADERS})
SELECT type, count(*) AS n_edges, count(*) FILTER (dst NOT IN (SELECT id FROM n)) AS n_broken FROM (SELECT DISTINCT * FROM e WHERE src <> dst) GROUP BY 1""")
def edge_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of each type, and those whose target isn't a node."""
    nodes = table(spark, sf_dir, "customer").select(_key("C", "c_custkey").alias("id")).unionByName(table(spark, sf_dir, "supplier").select(_key("S", "s_suppkey").alias("id")))
    edges = _trades(spark, sf_dir).withColumn("type", F.lit("trades")).unionByName(foreign_key_graph(spark, sf_dir)[1].withColumn("type", F.lit("part_of")))
    return graph.valid_edges(nodes, edges).groupBy("type").agg(F.count("*").alias("n_edges"), F.count_if("broken").alias("n_broken"))


_LAYERS = {"C": 2, "S": 2, "N": 1, "R": 0}
_LAYERED = f"SELECT src, dst FROM ({_EDGES}) UNION ALL SELECT src, dst FROM ({_TRADES}) UNION ALL SELECT dst, src FROM ({_EDGES}) WHERE src LIKE 'S%'"
_LAYER_OF = "CASE substr({0}, 1, 1) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _LAYERS.items()) + " END"


@query(f"""
SELECT src, dst, {_LAYER_OF.format('src')} AS src_layer, {_LAYER_OF.format('dst')} AS dst_layer FROM ({_LAYERED})
WHERE {_LAYER_OF.format('src')} < {_LAYER_OF.format('dst')} OR ({_LAYER_OF.format('src')} = {_LAYER_OF.format('dst')} AND {_LAYER_OF.format('src')} <> 0)""")
def layer_violation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that go up or stay inside a layer: regions, nations, and those who trade."""
    nodes, edges = foreign_key_graph(spark, sf_dir)
    upward = edges.where("src LIKE 'S%'").select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    of = F.create_map(*(F.lit(x) for pair in _LAYERS.items() for x in pair))
    layers = nodes.select("id", of[F.substring("id", 1, 1)].alias("layer"))
    return graph.layer_violations(edges.unionByName(_trades(spark, sf_dir)).unionByName(upward), layers).select("src", "dst", "src_layer", "dst_layer")
