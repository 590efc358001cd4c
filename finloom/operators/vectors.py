"""An inverted file over vectors: cells around centroids, searched where a query is near.

Centroids are fitted on a bounded sample; every row is in the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.operators.similarity import PART_VECTORS, QUERY_BLOCK, best_matches, scan_cells
from finloom.storage import materialise

#: Rows that centroids are fitted on at most, and rounds of the fit.
SAMPLE_ROWS, ROUNDS = 50_000, 10


@dataclass
class VectorIndex:
    """``rows`` (cell, id, v) is written; ``centroids`` has a row a cell."""

    rows: DataFrame
    centroids: np.ndarray


def fit_centroids(vectors: DataFrame, cells: int, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> np.ndarray:
    """Centroids of id, v by Lloyd's method, on the ``sample_rows`` rows (all, if there are
    fewer) whose hashed ids are smallest.  Fewer rows than ``cells``: a cell a row."""
    picked = vectors.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample_rows).select("v").collect()  # a bounded sample
    if not picked:
        return np.zeros((1, 1))
    points = np.array([r.v for r in picked], np.float64)
    rng = np.random.default_rng(seed)
    centroids = points[rng.permutation(len(points))[:cells]].copy()
    for _ in range(ROUNDS):
        near = np.argmax(_closeness(points, centroids), axis=1)
        totals, n = np.zeros_like(centroids), np.bincount(near, minlength=len(centroids))
        np.add.at(totals, near, points)
        centroids[n > 0] = totals[n > 0] / n[n > 0, None]
    return centroids


def _closeness(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Larger for centroids that are nearer."""
    return 2 * points @ centroids.T - (centroids**2).sum(axis=1)


def _in_cells(vectors: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """id and v once for each of the ``probes`` nearest cells: cell, id, v."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                points = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                order = np.argsort(-_closeness(points, centroids), axis=1, kind="stable")[:, :probes]
                row = np.repeat(np.arange(part.num_rows), order.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(order.ravel().astype(np.int64)), *(c.take(pa.array(row)) for c in part.columns)], ["cell", "id", "v"])

    return vectors.mapInArrow(place, "cell long, id long, v array<double>")


def _rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))


def build_index(vectors: DataFrame, cells: int, key: str = "id", vector: str = "vector", sample_rows: int = SAMPLE_ROWS) -> VectorIndex:
    """Index of all rows whose vector isn't null."""
    known = _rows(vectors, key, vector)
    centroids = fit_centroids(known, cells, sample_rows)
    return VectorIndex(materialise(_in_cells(known, centroids, 1), "vector-index"), centroids)


def indexed_matches(
    index: VectorIndex, queries: DataFrame, probes: int, threshold: float, key: str = "id", vector: str = "vector", block: int = QUERY_BLOCK, part: int = PART_VECTORS
) -> DataFrame:
    """For each query the other vector of the greatest dot product in its ``probes``
    nearest cells, if it is ``threshold`` at least: query, match, score (four
    digits); ties by smaller id.

    Products are exact, so only a match outside the probed cells can be missed;
    with as many probes as cells nothing is.  A cell of more vectors than ``part``
    or queries than ``block`` is cut into a grid of parts and blocks.
    """
    asked = materialise(_in_cells(_rows(queries, key, vector), index.centroids, probes), "vector-queries")
    n_vectors = index.rows.groupBy("cell").agg(F.ceil(F.count("*") / part).alias("parts"))
    n_queries = asked.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("blocks"))
    # One row a cell; cells without queries aren't read.
    grid = materialise(n_vectors.join(n_queries, "cell").select("cell", "parts", "blocks"), "vector-grid")

    def placed(df: DataFrame, own: str, other: str, is_vector: bool) -> DataFrame:
        rows = df.join(grid, "cell").withColumn("own", F.pmod(F.xxhash64("id"), F.col(own)))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        of = ("own", "other") if is_vector else ("other", "own")
        slot = F.xxhash64("cell", *of)
        return rows.select(slot.alias("cell"), F.lit(is_vector).alias("is_vector"), "id", "v")

    both = placed(asked, "blocks", "parts", False).unionByName(placed(index.rows, "parts", "blocks", True))
    found = both.repartition("cell").sortWithinPartitions("cell", "is_vector").mapInArrow(scan_cells, "query long, match long, score double")
    order = F.struct("score", -F.col("match"))
    best = found.groupBy("query").agg(F.max_by("match", order).alias("match"), F.max("score").alias("s"))
    return best.where(F.col("s") >= threshold).select("query", "match", F.round("s", 4).alias("score"))


def probes_for(index: VectorIndex, target: float = 0.95, sample_queries: int = 500, seed: int = 11) -> int:
    """Cells to look into so that the share ``target`` of matches is in them.

    Measured: the ``sample_queries`` rows with the smallest hashed ids (a bounded
    sample) are matched by the exact scan; a match needs as many probes as its
    cell's place among the query's cells.  On vectors without clusters that is
    most cells, as no index can do better there.
    """
    rows = index.rows.select("id", F.col("v").alias("vector"))
    asked = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample_queries)
    exact = best_matches(rows, materialise(asked, "vector-sample"), float("-inf"))
    cell = index.rows.select(F.col("id").alias("match"), "cell").groupBy("match").agg(F.min("cell").alias("cell"))
    known = exact.join(cell, "match").join(asked.select(F.col("id").alias("query"), "vector"), "query").select("cell", "vector").collect()
    if not known:
        return len(index.centroids)
    order = np.argsort(-_closeness(np.array([r.vector for r in known]), index.centroids), axis=1, kind="stable")
    places = np.sort(np.argmax(order == np.array([r.cell for r in known])[:, None], axis=1)) + 1
    return int(places[min(len(places) - 1, int(np.ceil(target * len(places))) - 1)])


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the queries of ``exact`` whose match ``found`` has, or one of equal score."""
    both = exact.alias("e").join(found.alias("f"), "query", "left")
    hit = F.coalesce(F.col("f.score") >= F.col("e.score"), F.lit(False))
    return both.agg(F.coalesce(F.avg(hit.cast("double")), F.lit(1.0))).first()[0]
