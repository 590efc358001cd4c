"""Queries of layered resolution and of the vector index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators import resolution, vectors
from finloom.plans.catalog import query
from finloom.session import table

# Parts by name and type are known; documents' sources and customers' names are asked
# for; the names of brands are aliases of the cheapest part of each.
_MASTER = "SELECT p_partkey AS id, p_name AS name, p_type AS type FROM part"
_ALIASES = "SELECT p_brand || ' ' || split_part(p_name, ' ', 1) AS alias, p_partkey AS id FROM part"
_ASKED = """SELECT DISTINCT name, type FROM (
  SELECT p_name AS name, p_type AS type FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_name, p_brand FROM part WHERE p_partkey % 3 = 1
  UNION ALL SELECT p_brand || '-' || split_part(p_name, ' ', 1), NULL FROM part UNION ALL SELECT p_name || 's', p_type FROM part WHERE p_partkey % 3 = 2
  UNION ALL SELECT c_name, c_mktsegment FROM customer)"""
_LEV = "1 - levenshtein({0}, {1}) / greatest(length({0}), length({1}))"
_LONG = "abs(length({0}) - length({1})) <= 0.2 * greatest(length({0}), length({1}))"
_TEXT = f"""m AS MATERIALIZED ({_MASTER}), a AS MATERIALIZED (SELECT DISTINCT * FROM ({_ALIASES})), q AS MATERIALIZED ({_ASKED}),
l1 AS (SELECT q.name, q.type, m.id::VARCHAR AS id, m.name AS match, NULL AS alias, 1.0 AS s, 1 AS n FROM q JOIN m ON q.name = m.name AND (q.type = m.type OR q.type IS NULL)),
l2 AS (SELECT q.name, q.type, m.id::VARCHAR, m.name, NULL, 1.0, 2 FROM q JOIN m ON q.name = m.name),
qn AS MATERIALIZED (SELECT DISTINCT name FROM q WHERE name NOT IN (SELECT name FROM m)), an AS (SELECT DISTINCT alias FROM a), mn AS (SELECT DISTINCT name AS match FROM m),
pa AS MATERIALIZED (SELECT name, alias, {_LEV.format('name', 'alias')} AS s FROM qn JOIN an ON {_LONG.format('name', 'alias')} WHERE {_LEV.format('name', 'alias')} > 0.8 + 1e-12),
pm AS MATERIALIZED (SELECT name, match, {_LEV.format('name', 'match')} AS s FROM qn JOIN mn ON {_LONG.format('name', 'match')} WHERE {_LEV.format('name', 'match')} > 0.8 + 1e-12),
l3 AS (SELECT q.name, q.type, m.id::VARCHAR, m.name, pa.alias, pa.s, 3 FROM q JOIN pa USING (name) JOIN a ON a.alias = pa.alias JOIN m ON m.id = a.id),
l4 AS (SELECT q.name, q.type, m.id::VARCHAR, m.name, NULL, pm.s, 4 FROM q JOIN pm USING (name) JOIN m ON m.name = pm.match),
u AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3 UNION ALL SELECT * FROM l4),
b AS (SELECT *, row_number() OVER (PARTITION BY name, type ORDER BY n, s DESC, alias, match, id) AS place FROM u),
t AS MATERIALIZED (SELECT q.name, q.type, b.id, b.match, b.alias AS matched_alias, round(b.s, 6) AS similarity, CASE n WHEN 1 THEN 'exact' WHEN 2 THEN 'exact_name' WHEN 3 THEN 'alias_fuzzy' WHEN 4 THEN 'name_fuzzy' END AS layer
  FROM q LEFT JOIN b ON b.name = q.name AND b.type IS NOT DISTINCT FROM q.type AND b.place = 1)"""


def _named(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    key, first = F.col("p_partkey") % 3, F.substring_index("p_name", " ", 1)
    master = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("type"))
    aliases = part.select(F.concat("p_brand", F.lit(" "), first).alias("alias"), F.col("p_partkey").alias("id"))
    asked = (
        part.where(key == 0).select(F.col("p_name").alias("name"), F.col("p_type").alias("type"))
        .unionAll(part.where(key == 1).select("p_name", "p_brand"))
        .unionAll(part.select(F.concat("p_brand", F.lit("-"), first), F.lit(None).cast("string")))
        .unionAll(part.where(key == 2).select(F.concat("p_name", F.lit("s")), "p_type"))
        .unionAll(customer.select("c_name", "c_mktsegment"))
    )
    return asked, master, aliases


@query(f"WITH {_TEXT} SELECT * FROM t")
def names_resolved_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts, aliases and customers among parts: by key, name, alias and similarity."""
    found = resolution.resolve_by_text(*_named(spark, sf_dir))
    return found.withColumn("similarity", F.round("similarity", 6))


@query(f"""
WITH {_TEXT}, e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
r AS (SELECT t.name, t.type, e.v FROM t LEFT JOIN customer ON c_name = t.name LEFT JOIN e ON vec_id = c_custkey WHERE layer IS NULL),
k AS (SELECT id, m.name AS match, v FROM m JOIN e ON vec_id = id WHERE id % 2 = 0),
s AS (SELECT name, type, k.id, k.match, list_dot_product(r.v, k.v) AS s FROM r JOIN k ON r.v IS NOT NULL),
f AS (SELECT name, type, arg_max(id, (s, -id)) AS id, round(max(s), 4) AS s FROM s GROUP BY 1, 2 HAVING max(s) >= 0.3)
SELECT name, type, id, match, matched_alias, similarity, layer, true AS resolved FROM t WHERE layer IS NOT NULL
UNION ALL SELECT r.name, r.type, f.id::VARCHAR, m.name, NULL, f.s, CASE WHEN f.id IS NULL THEN 'new' ELSE 'embedding' END, f.id IS NOT NULL
FROM r LEFT JOIN f ON f.name = r.name AND f.type IS NOT DISTINCT FROM r.type LEFT JOIN m ON m.id = f.id""")
def names_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, then by embeddings what texts don't resolve; what is left is new."""
    asked, master, aliases = _named(spark, sf_dir)
    embedded = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    of_names = table(spark, sf_dir, "customer").join(embedded, F.col("c_custkey") == F.col("id")).select(F.col("c_name").alias("name"), "vector")
    of_master = embedded.join(master.select("id"), "id").where("id % 2 = 0")
    found = resolution.resolve_all(asked, master, aliases, of_names, of_master, near=0.3)
    return found.withColumn("similarity", F.round("similarity", 6))


@query()
def vector_index_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest other vector of each queried one (ids divisible by 100), by the index of all rows."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    index = vectors.build_index(rows, max(1, int(rows.count() ** 0.5)))
    return vectors.indexed_matches(index, rows.where("id % 100 = 0"), vectors.probes_for(index), 0.3)
