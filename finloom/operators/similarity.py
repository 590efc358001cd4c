"""Similarity joins and entity resolution."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.functions.text import jaccard, levenshtein_similarity
from finloom.operators.graph import components
from finloom.storage import materialise, spread, temporary

#: Query vectors that a task holds (32 MB at 64 dimensions), and vectors that
#: stream over them.
QUERY_BLOCK, PART_VECTORS = 65_536, 4_000_000


def _parity(half: int, tokens: str = "rare") -> Column:
    """64 of the 128 bits of a set: each says whether an odd number of its tokens fall on it."""
    bit = f"if((xxhash64(x) & 64) = {64 * half}, shiftleft(1L, CAST(xxhash64(x) & 63 AS INT)), 0L)"
    return F.expr(f"aggregate({tokens}, 0L, (bits, x) -> bits ^ {bit})")


def _prefixed(sets: DataFrame, key: str, tokens: str, keep: Column, carried: tuple[str, ...] = (), made: tuple[Column, ...] = ()) -> DataFrame:
    """key, size, the ``carried`` columns, those ``made`` of all tokens (column ``rare``)
    and one row for each of its ``keep`` rarest tokens; the number of tokens to keep is an
    expression of the column ``size``."""
    flat = sets.select(key, *carried, F.size(tokens).alias("size"), F.explode(tokens).alias("token"))
    counts = flat.groupBy("token").agg(F.count("*").alias("n"))
    ordered = (
        flat.join(spread(counts), "token")
        .groupBy(key, *carried, "size")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda x: x["token"]).alias("rare"))
    )
    return ordered.select(key, *carried, *made, "size", F.explode(F.slice("rare", F.lit(1), keep)).alias("token"))


def similar_sets(sets: DataFrame, key: str, tokens: str, threshold: float) -> DataFrame:
    """Pairs a < b of keys whose token sets have a Jaccard similarity of at least
    ``threshold``, with the similarity (four digits).

    Sets must be distinct arrays of distinct tokens; empty ones have no pair.
    Two similar sets share one of their rarest tokens, so only these meet: a
    token that everything holds joins nothing.  Of those that meet, most are told apart
    by bits: a token that only one of two sets holds changes one of 128, so sets whose
    bits differ more than tokens of similar ones can make no row.
    """
    n = F.col("size")
    keep = (n - F.ceil(n * F.lit(threshold) - 1e-9).cast("int") + 1).cast("int")
    bits = tuple(_parity(i).alias(f"bits_{i}") for i in range(2))
    rare = materialise(_prefixed(sets.where(F.size(tokens) > 0), key, tokens, keep, made=bits), "similar-sets")
    a, b = (rare.select(F.col(key).alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("size", "bits_0", "bits_1")), "token") for x in "ab")
    low, high = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    apart = sum(F.bit_count(F.col(f"a_bits_{i}").bitwiseXOR(F.col(f"b_bits_{i}"))) for i in range(2))
    near = apart <= (low + high) * F.lit((1 - threshold) / (1 + threshold)) + 1e-6
    # Keys meet without their sets, which are fetched for pairs that are left.
    met = a.join(b, "token").where((F.col("a") < F.col("b")) & (low >= threshold * high - 1e-9) & near).select("a", "b").distinct()
    a_set, b_set = (sets.select(F.col(key).alias(x), F.col(tokens).alias(f"{x}_set")) for x in "ab")
    return (
        met.join(a_set, "a")
        .join(b_set, "b")
        .withColumn("similarity", jaccard(F.col("a_set"), F.col("b_set")))
        .where(F.col("similarity") >= threshold - 1e-9)
        .select("a", "b", F.round("similarity", 4).alias("similarity"))
    )


def similar_classes(rows: DataFrame, key: str, tokens: str, threshold: float) -> DataFrame:
    """key, class_id, n_copies and n_links of every row, copies included, without
    a pair of copies: rows of one set are a class, and classes are compared.

    class_id is the smallest key that links connect a row with, n_copies counts
    the rows of its set, itself included, and n_links the rows whose sets have a
    Jaccard similarity of at least ``threshold`` with its own, itself left out.
    Keys aren't null; repeats of tokens and their order don't count, nor do null
    ones.  Rows without tokens are alone.  Other columns are ignored.
    """
    words = F.array_sort(F.array_distinct(F.array_compact(F.coalesce(tokens, F.array().cast("array<string>")))))
    sets = rows.select(F.col(key).alias("_key"), words.alias("_words"))
    some = F.size("_words") > 0
    with temporary(rows.sparkSession) as kept:
        classes = materialise(sets.where(some).groupBy("_words").agg(F.min("_key").alias("_holder"), F.count("*").alias("n_copies")), "similar-classes")
        pairs = materialise(similar_sets(classes, "_holder", "_words", threshold).select("a", "b"), "similar-links")
        joined = components(pairs)
        copies = classes.select(F.col("_holder").alias("b"), "n_copies")
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        linked = both.join(spread(copies), "b").groupBy(F.col("a").alias("_linked_key")).agg(F.sum("n_copies").alias("_linked"))
        verdicts = (
            classes.join(linked, F.col("_holder") == F.col("_linked_key"), "left")
            .join(joined, F.col("_holder") == F.col("vertex"), "left")
            .select("_words", F.coalesce("root", "_holder").alias("class_id"), "n_copies", (F.col("n_copies") - 1 + F.coalesce("_linked", F.lit(0))).alias("n_links"))
        )
        kept.append(materialise(verdicts, "similar-verdicts"))
    found = sets.where(some).join(kept[0], "_words").select(F.col("_key").alias(key), "class_id", "n_copies", "n_links")
    alone = sets.where(~some).select(F.col("_key").alias(key), F.col("_key").alias("class_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone)


def fuzzy_pairs(names: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """name, match and likeness of all pairs of a name and a known string (match) whose
    Levenshtein similarity is over ``threshold``; both distinct, not empty.

    Strings that are similar share one of their rarest two-letter runs, so only
    those are compared: each of at most k edits spoils two runs, and k is less
    than (1 - t) / t of the length.  Under a threshold of 0.75 that could spoil
    all runs of a string; letters, numbered by their occurrence, take their place
    then.  A threshold of 0.5 or less would have to compare everything.
    """
    if threshold <= 0.5:
        raise ValueError("the threshold must be over 0.5")
    runs, spoiled = "substring({0}, i, 2)", 2
    if threshold < 0.75:
        runs, spoiled = "concat(substring({0}, i, 1), i - length(replace(substring({0}, 1, i), substring({0}, i, 1), '')))", 1

    def grams(df: DataFrame, col: str) -> DataFrame:
        found = f"array_distinct(transform(sequence(1, greatest(1, length({col}) - {spoiled - 1})), i -> {runs.format(col)}))"
        return df.select(*df.columns, F.expr(found).alias("grams"))

    loss = (1 - threshold) / threshold
    # A string says itself which sides it is on, so no side is joined again for its runs.
    sides = names.select(F.col("name").alias("s"), F.lit(1).alias("side")).unionByName(known.select(F.col("match").alias("s"), F.lit(2).alias("side")))
    both = sides.groupBy("s").agg(F.bit_or("side").alias("sides"))
    keep = (spoiled * F.floor(F.length("s") * F.lit(loss)) + 1).cast("int")
    rare = materialise(_prefixed(grams(both, "s"), "s", "grams", keep, ("sides",)).select("s", "sides", "token"), "fuzzy-runs")
    left = rare.where("sides & 1 <> 0").select(F.col("s").alias("name"), "token")
    right = rare.where("sides & 2 <> 0").select(F.col("s").alias("match"), "token")
    met = left.join(right, "token").select("name", "match").distinct()
    return met.withColumn("likeness", levenshtein_similarity(F.col("name"), F.col("match"))).where(F.col("likeness") > threshold + 1e-12)


def resolve_names(names: DataFrame, master: DataFrame, threshold: float = 0.8) -> DataFrame:
    """name, match and layer (exact, fuzzy or new) of every distinct name.

    master: name.  First equality in lower case, then the most similar master
    name of a Levenshtein similarity over ``threshold``, ties by name.  Names
    that are similar share one of their rarest two-letter runs, so only those
    are compared.
    """
    wanted = names.select(F.lower("name").alias("name")).where("name <> ''").distinct()
    known = master.select(F.lower("name").alias("match")).where("match <> ''").distinct()
    exact = wanted.join(known, F.col("name") == F.col("match"), "left_semi").select("name", F.col("name").alias("match"), F.lit("exact").alias("layer"))
    rest = wanted.join(known, F.col("name") == F.col("match"), "left_anti")

    pairs = fuzzy_pairs(rest, known, threshold)
    fuzzy = pairs.groupBy("name").agg(F.min_by("match", F.struct(-F.col("likeness"), "match")).alias("match"))
    found = rest.join(fuzzy, "name", "left").select("name", "match", F.when(F.col("match").isNull(), "new").otherwise("fuzzy").alias("layer"))
    return exact.unionByName(found)


def best_matches(
    vectors: DataFrame, queries: DataFrame, threshold: float, key: str = "id", vector: str = "vector", block: int = QUERY_BLOCK
) -> DataFrame:
    """For each query the other vector of the greatest dot product, if it is
    ``threshold`` at least: query, match, score (four digits); ties by smaller id.

    A stated set of queries against all vectors, as a grid: queries fall into
    blocks and vectors into parts, and a cell of the grid is one block, held in
    memory, over which one part streams.  A cell returns one row a query.  Null
    vectors match nothing.
    """
    number = F.col(vector).cast("array<double>").alias("v")
    known = vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), number)
    asked = queries.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), number)
    spark = vectors.sparkSession
    blocks = max(1, -(-asked.count() // block))
    parts = max(1, -(-known.count() // PART_VECTORS), int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks)

    def cells(df: DataFrame, own: str, n_own: int, other: str, n_other: int, is_vector: bool) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int"))
        placed = placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
        return placed.select((F.col("block") * parts + F.col("part")).cast("long").alias("cell"), F.lit(is_vector).alias("is_vector"), "id", "v")

    grid = cells(asked, "block", blocks, "part", parts, False).unionByName(cells(known, "part", parts, "block", blocks, True))

    found = grid.repartition("cell").sortWithinPartitions("cell", "is_vector").mapInArrow(scan_cells, "query long, match long, score double")
    order = F.struct("score", -F.col("match"))
    return (
        found.groupBy("query")
        .agg(F.max_by("match", order).alias("match"), F.max("score").alias("s"))
        .where(F.col("s") >= threshold)
        .select("query", "match", F.round("s", 4).alias("score"))
    )


def scan_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells (cell, is_vector, id, v), queries before vectors: the best vector
    of each query of a cell.  A cell's queries are held, its vectors stream."""
    now, held, best = None, [], None

    def close() -> Iterator[pa.RecordBatch]:
        if best is not None:
            ids, _, top, who = best
            at = np.flatnonzero(top > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(who[at]), pa.array(top[at])], ["query", "match", "score"])

    for batch in batches:
        cell, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        change = np.flatnonzero((cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *change], [*change, len(cell)]):
            if a == b:
                continue
            if cell[a] != now:
                yield from close()
                now, held, best = cell[a], [], None
            piece = batch.slice(a, b - a)
            ids = piece.column(2).to_numpy()
            rows = piece.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            if not kind[a]:
                held.append((ids, rows))
            elif held or best is not None:
                if best is None:
                    own = np.concatenate([x for x, _ in held])
                    best = (own, np.concatenate([x for _, x in held]), np.full(len(own), -np.inf), np.zeros(len(own), np.int64))
                    held = []
                _better(best, ids, rows)
    yield from close()


def _better(best: tuple[np.ndarray, ...], ids: np.ndarray, rows: np.ndarray, at_once: int = 1024) -> None:
    """Compare a block's queries with more vectors, some queries at a time."""
    own, matrix, top, who = best
    for low in range(0, len(own), at_once):
        part = slice(low, low + at_once)
        scores = matrix[part] @ rows.T
        scores[own[part, None] == ids[None, :]] = -np.inf
        high = scores.max(axis=1)
        first = np.where(scores == high[:, None], ids[None, :], np.iinfo(np.int64).max).min(axis=1)
        better = (high > top[part]) | ((high == top[part]) & (first < who[part]))
        top[part], who[part] = np.where(better, high, top[part]), np.where(better, first, who[part])


def link_aliases(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """name and target (null where unknown) by lower-case equality; of repeated
    aliases (alias, target, pos) the last wins."""
    last = aliases.groupBy(F.lower("alias").alias("alias")).agg(F.max_by("target", "pos").alias("target"))
    return names.join(last, F.lower("name") == F.col("alias"), "left").select("name", "target")


def resolve_endpoints(links: DataFrame, ids: DataFrame) -> DataFrame:
    """Links (from_key, to_key) as edges (src, dst); a link with an unknown end is dropped."""
    a, b = (ids.select(F.col("key").alias(f"{x}_key"), F.col("id").alias(x)) for x in ("from", "to"))
    return links.join(a, "from_key").join(b, "to_key").select(F.col("from").alias("src"), F.col("to").alias("dst"))


def citations_in_order(papers: DataFrame, existing: DataFrame) -> DataFrame:
    """Citations (src, dst) of papers (pos, id, cites): the target exists already
    (existing: id) or is a paper seen earlier in input order."""
    seen = papers.groupBy("id").agg(F.min("pos").alias("seen")).unionByName(existing.select("id", F.lit(-1).cast("long").alias("seen")))
    first = seen.groupBy(F.col("id").alias("dst")).agg(F.min("seen").alias("seen"))
    cited = papers.select(F.col("id").alias("src"), "pos", F.explode("cites").alias("dst"))
    return cited.join(first, "dst").where(F.col("seen") < F.col("pos")).select("src", "dst").distinct()
