"""Layered resolution of names: by key, name, alias, similar name and embedding.

A cascade of remainders: a layer sees only the names that the layers before it
left, so an expensive layer runs on few.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.operators.similarity import best_matches, fuzzy_pairs
from finloom.storage import materialise, spread


def _best(found: DataFrame, layer: str) -> DataFrame:
    """One row a name and type: the most similar, then by alias, name and id."""
    row = F.struct((-F.col("similarity")).alias("s"), "matched_alias", "match", "id")
    best = found.groupBy("name", "type").agg(F.min(row).alias("b"))
    return best.select("name", "type", "b.id", "b.match", "b.matched_alias", (-F.col("b.s")).alias("similarity"), F.lit(layer).alias("layer"))


def resolve_by_text(names: DataFrame, master: DataFrame, aliases: DataFrame, threshold: float = 0.8) -> DataFrame:
    """name, type, id, match (the master's name), matched_alias, similarity and layer of
    every distinct (name, type); layer is null where no layer finds one.

    master: id, name, type; aliases: alias, id.  Layers: ``exact`` (name and type),
    ``exact_name`` (name, whatever the type), ``alias_fuzzy`` and ``name_fuzzy``
    (Levenshtein similarity over ``threshold``, letter case counts).  A null type
    stands for names without types (concepts): equality of names is ``exact``.
    Of several matches the most similar wins, then the smallest alias, name and
    id, as text.  Null and empty names match nothing; aliases of unknown ids are
    ignored.
    """
    rest = materialise(names.select(F.col("name").cast("string").alias("name"), F.col("type").cast("string").alias("type")).distinct(), "resolution-names")
    known = master.where("name <> ''").select(F.col("id").cast("string").alias("id"), F.col("name").alias("match"), F.col("type").alias("m_type"))
    # Of a name's ids the smallest wins, of an alias's names the smallest and its id: a
    # name that many masters have joins one row of them.
    id_of = materialise(spread(known).groupBy("match", "m_type").agg(F.min("id").alias("id")), "resolution-known")
    named = materialise(id_of.groupBy("match").agg(F.min("id").alias("id")), "resolution-titles")
    called = aliases.where("alias <> ''").select("alias", F.col("id").cast("string").alias("id")).join(known, "id")
    called = materialise(spread(called).groupBy("alias").agg(F.min(F.struct("match", "id")).alias("k")).select("alias", "k.*"), "resolution-aliases")
    one, none = F.lit(1.0).alias("similarity"), F.lit(None).cast("string").alias("matched_alias")
    own = ("name", "type", "id", "match")

    def layers():
        nonlocal rest
        typed = rest.join(id_of, (F.col("name") == F.col("match")) & F.coalesce(F.col("type") == F.col("m_type"), F.col("type").isNull()))
        yield _best(typed.select(*own, none, one), "exact")
        yield _best(rest.join(named, F.col("name") == F.col("match")).select(*own, none, one), "exact_name")
        left = rest.where("name <> ''").select("name").distinct()
        pairs = fuzzy_pairs(left, called.select(F.col("alias").alias("match")), threshold).withColumnRenamed("match", "alias")
        yield _best(rest.join(pairs, "name").join(called, "alias").select(*own, F.col("alias").alias("matched_alias"), F.col("likeness").alias("similarity")), "alias_fuzzy")
        left = rest.where("name <> ''").select("name").distinct()
        pairs = fuzzy_pairs(left, named.select("match"), threshold)
        yield _best(rest.join(pairs, "name").join(named, "match").select(*own, none, F.col("likeness").alias("similarity")), "name_fuzzy")

    found = None
    for layer in layers():
        hit = materialise(layer, "resolution-layer")
        found = hit if found is None else found.unionByName(hit)
        same = F.col("r.name").eqNullSafe(F.col("h.name")) & F.col("r.type").eqNullSafe(F.col("h.type"))
        rest = materialise(rest.alias("r").join(hit.alias("h"), same, "left_anti"), "resolution-rest")
    missing = rest.select("name", "type", *(F.lit(None).cast(t).alias(c) for c, t in (("id", "string"), ("match", "string"), ("matched_alias", "string"), ("similarity", "double"), ("layer", "string"))))
    return found.unionByName(missing)


def resolve_all(
    names: DataFrame, master: DataFrame, aliases: DataFrame, name_vectors: DataFrame, master_vectors: DataFrame, threshold: float = 0.8, near: float = 0.8,
    matches: Callable[[DataFrame, DataFrame, float], DataFrame] = best_matches,
) -> DataFrame:
    """``resolve_by_text``, then for what is left the master of the greatest dot product
    of embeddings, if it is ``near`` at least (layer ``embedding``, similarity to four
    digits), else layer ``new``; resolved says whether there is a match.

    name_vectors: name, vector; master_vectors: id (a number), vector.  ``matches``
    finds them: the exact scan, or a search of an index.
    """
    text = materialise(resolve_by_text(names, master, aliases, threshold), "resolution-text")
    left = text.where("layer IS NULL AND name IS NOT NULL").select("name").distinct()
    # Numbers below those of the master, so that no query is a vector's own.
    numbered = materialise(left.join(name_vectors.select("name", "vector"), "name").select("name", "vector", (-1 - F.monotonically_increasing_id()).alias("id")), "resolution-asked")
    found = matches(master_vectors.select("id", "vector"), numbered.select("id", "vector"), near)
    of = found.join(numbered.select(F.col("id").alias("query"), "name"), "query").select("name", F.col("match").cast("string").alias("e_id"), "score")
    best = of.groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("s"), "e_id")).alias("b"))
    titles = master.select(F.col("id").cast("string").alias("e_id"), F.col("name").alias("e_match"))
    near_by = best.select("name", F.col("b.e_id").alias("e_id"), (-F.col("b.s")).alias("score")).join(titles, "e_id", "left")
    rest = text.where("layer IS NULL").select("name", "type").join(near_by, "name", "left")
    by_vector = rest.select(
        "name", "type", F.col("e_id").alias("id"), F.col("e_match").alias("match"), F.lit(None).cast("string").alias("matched_alias"), F.col("score").alias("similarity"),
        F.when(F.col("e_id").isNotNull(), "embedding").otherwise("new").alias("layer"),
    )
    return text.where("layer IS NOT NULL").unionByName(by_vector).withColumn("resolved", F.col("layer") != "new")
