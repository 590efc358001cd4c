"""N-gram Jaccard self-join by chosen paths.

Documents are sets of word n-grams.  Equal sets form a class, and classes are
joined.  A run puts every set into the bucket of one sampled token, the
smallest of its n-grams under a random order, which two sets share with
probability equal to their similarity.  A bucket splits recursively, on further
sampled tokens that its sets share, down to small buckets, which are compared by
brute force.  A part that keeps most of its bucket is not split further: its
sets are so alike that splitting can't tell them apart.  Runs are repeated until
a pair at the threshold is met with the target recall.

Tasks split and compare whole buckets on sketches; only a bucket of more sets
than a task should hold is split (or, if its sets are alike, cut into blocks)
before it reaches one.  What leaves a bucket are groups of candidates, as one
edge a set, never their pairs.  The groups of all buckets are joined, the
n-grams of every set in a group are fetched once, and an exact comparison
counts the links of each set, block against block in large groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import discard, hand_over, materialise, rows, spread, text_column, text_hash
from finloom.llm.substring_dedup import run_hashes, word_hashes
from finloom.operators.graph import components

NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Tokens of a sketch, of one byte each, and how far below the threshold an
#: estimate may be (over four standard deviations) for the pair to be a candidate.
SKETCH, SLACK = 64, 0.21
#: A bucket of no more sets is compared by brute force, and one of no more
#: sets is split inside a task.
SMALL_SETS, BUCKET_SETS = 256, 8192
#: Tokens that a bucket is split on (with two, 94 % of the pairs at 0.8 meet
#: again at any depth, while what is less alike thins out), and the share of a
#: bucket in one part from which its sets are alike.
SPLITS, ALIKE = 2, 0.5
#: Sets of a block of a group whose links are counted; n-grams that count as one
#: set more; n-grams (columns) of a matrix product that counts what sets share;
#: and the share of pairs with an n-gram from which it goes through the product.
COUNT_SETS, COUNT_NGRAMS, COLUMNS, DENSE = 2048, 1000, 4096, 0.005
#: Sets up to which all pairs of sketches are compared at once.
TINY = 24
SEED = 7
#: Bits of the filter of rows whose texts are fetched: 8 MB in 2,048 pages at most.
FILTER_BITS = 1 << 26
_ODD = np.uint64(0x9E3779B97F4A7C15)


def runs_for(recall: float, threshold: float) -> int:
    """Runs after which a pair at the threshold was in one bucket with this probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold))) if threshold < 1 else 1


def kept_together(threshold: float) -> float:
    """Share of the pairs at the threshold that splits keep together at any depth:
    the fixed point of p = 1 - (1 - threshold * p) ** SPLITS (0 for low thresholds)."""
    p = 1.0
    for _ in range(1000):
        p = 1 - (1 - threshold * p) ** SPLITS
    return p


def ngram_set(words: list[bytes], n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the n-grams; a shorter text is one n-gram."""
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(run_hashes(word_hashes(words), min(n, len(words))))


def set_key(ngrams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(ngrams.tobytes())


def minima(sets: list[np.ndarray], tokens: int) -> np.ndarray:
    """The smallest n-gram of every (non-empty) set under each random order."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, tokens, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, tokens, np.uint64)
    out = np.empty((len(sets), tokens), np.uint64)
    if sets:
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        for i in range(tokens):
            out[:, i] = np.minimum.reduceat(flat * factors[i] + shifts[i], starts)
    return out


def _signatures(docs: DataFrame, ngram: int, runs: int) -> DataFrame:
    """doc_id, row_hash, key, size, sketch and roots (a token of each run);
    a text without words has null instead."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            sets = [ngram_set(x.split(), ngram) for x in batch.column(2).to_pylist()]
            full = [i for i, x in enumerate(sets) if len(x)]
            low = minima([sets[i] for i in full], max(SKETCH, runs))
            mixed = (low ^ (low >> np.uint64(29))) * _ODD
            bytes_of = (mixed[:, :SKETCH] >> np.uint64(56)).astype(np.uint8)
            roots = (mixed[:, :runs] + np.arange(runs, dtype=np.uint64)).view(np.int64)
            keys: list = [None] * len(sets)
            sketches: list = [None] * len(sets)
            tokens: list = [None] * len(sets)
            for n, i in enumerate(full):
                keys[i], sketches[i], tokens[i] = set_key(sets[i]), bytes_of[n].tobytes(), roots[n]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(keys, pa.binary()),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(sketches, pa.binary()),
                    pa.array(tokens, pa.list_(pa.int64())),
                ],
                ["doc_id", "row_hash", "key", "size", "sketch", "roots"],
            )

    return docs.mapInArrow(
        signed, "doc_id long, row_hash long, key binary, size long, sketch binary, roots array<long>"
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows by the bucket they are sorted by, one group in memory at a time."""
    now, held = None, []
    for batch in batches:
        buckets = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(buckets)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and now != buckets[a]:
                yield pa.Table.from_batches(held)
                held = []
            now = int(buckets[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Union-find over rows; the smallest row of a tree is its root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def _coordinate(path: int) -> int:
    """The token that a path splits on; the tokens of runs aren't taken again."""
    return SKETCH // 4 + (path * 0x9E3779B97F4A7C15 + SEED) % (1 << 64) * (SKETCH - SKETCH // 4) // (1 << 64)


def _compare(rows: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, threshold: float, forest: _Forest) -> None:
    """Join all candidates among the rows.  A row joined to another needs no
    further comparison with what is joined already."""
    least = math.ceil((threshold - SLACK) * SKETCH)
    sketch, size = sketches[rows], sizes[rows]
    if len(rows) <= TINY:
        like = np.triu((sketch[:, None] == sketch).sum(axis=2) >= least, 1)
        for i, j in zip(*np.nonzero(like)):
            if min(size[i], size[j]) >= threshold * max(size[i], size[j]) - 1e-9:
                forest.join(int(rows[i]), int(rows[j]))
        return
    left = np.arange(len(rows))
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            i = todo.pop()
            like = (sketch[left] == sketch[i]).sum(axis=1) >= least
            if like.any():
                like &= np.minimum(size[left], size[i]) >= threshold * np.maximum(size[left], size[i]) - 1e-9
                for j in left[like].tolist():
                    forest.join(int(rows[i]), int(rows[j]))
                    todo.append(j)
                left = left[~like]


def candidate_groups(bucket: int, sketches: np.ndarray, sizes: np.ndarray, threshold: float) -> list[int]:
    """For each set of a bucket, the first of the sets that candidates connect it with."""
    forest = _Forest(len(sizes))
    todo = [(np.arange(len(sizes)), bucket % (1 << 64), False)]
    while todo:
        rows, path, alike = todo.pop()
        if alike or len(rows) <= SMALL_SETS:
            _compare(rows, sketches, sizes, threshold, forest)
            continue
        for j in range(SPLITS):
            part = (path * SPLITS + j) * 0xBF58476D1CE4E5B9 % (1 << 64)
            values = sketches[rows, _coordinate(part)]
            order = np.argsort(values, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(values[order])) + 1):
                if len(at) > 1:
                    todo.append((rows[at], part + int(values[at[0]]), len(at) > ALIKE * len(rows)))
    return [forest.root(i) for i in range(len(sizes))]


def _candidates(members: DataFrame, threshold: float) -> DataFrame:
    """Edges a, b (keys) that connect the candidates of every bucket."""

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []

        def edges() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (a, b)], ["a", "b"])
            a.clear(), b.clear()
            return out

        for table in _groups(batches):
            if table.num_rows < 2:
                continue
            keys = table.column("key").to_pylist()
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
            for i, j in enumerate(candidate_groups(table.column("bucket")[0].as_py(), sketches, table.column("size").to_numpy(), threshold)):
                if i != j and keys[i] != keys[j]:
                    a.append(keys[i])
                    b.append(keys[j])
            if len(a) >= 10_000:
                yield edges()
        if a:
            yield edges()

    return (
        members.select("bucket", "key", "size", "sketch")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "key")
        .mapInArrow(connect, "a binary, b binary")
        .distinct()
    )


def _counted(members: DataFrame) -> DataFrame:
    """c_bucket, n and before (sets of the bucket it is part of) of buckets with two sets or more."""
    return (
        members.groupBy(F.col("bucket").alias("c_bucket"))
        .agg(F.count("*").alias("n"), F.max("before").alias("before"))
        .where("n > 1")
    )


def _bucketed(classes: DataFrame, sets: int) -> tuple[DataFrame, list[DataFrame]]:
    """bucket, key, size and sketch of what tasks compare: the buckets of all
    runs, those of more than ``sets`` split or cut into blocks; and the tables
    that this reads."""
    columns = ["bucket", "key", "size", "sketch"]
    members = classes.select(F.explode("roots").alias("bucket"), "key", F.lit(None).cast("long").alias("before"))
    # Written, so that adaptive execution can split the join where a bucket is hot.
    counts = materialise(_counted(members), "jaccard-buckets")
    written = [counts]
    of_bucket = F.col("bucket") == F.col("c_bucket")
    # Most sets share no bucket of theirs: sketches travel after that is known.
    shared = members.drop("before").join(counts, of_bucket).select("bucket", "key", "n").join(classes.select("key", "size", "sketch"), "key")
    found = shared.where(F.col("n") <= sets).select(*columns)
    large = shared.where(F.col("n") > sets).select(*columns, "n")
    while not counts.where(F.col("n") > sets).isEmpty():
        large = materialise(large, "jaccard-large")
        path = F.xxhash64("bucket", "j")
        coordinate = F.pmod(path, F.lit(SKETCH - SKETCH // 4)) + SKETCH // 4 + 1
        parts = (
            large.withColumnRenamed("n", "before")
            .withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(SPLITS))))
            .withColumn("bucket", F.xxhash64(path, F.col("sketch").substr(coordinate.cast("int"), F.lit(1))))
            .select(*columns, "before")
        )
        counts = materialise(_counted(parts), "jaccard-buckets")
        written += [large, counts]
        alike = F.col("n") > F.greatest(F.lit(sets), F.col("before") * ALIKE)
        sized = parts.drop("before").join(counts, of_bucket)
        found = found.unionByName(sized.where(F.col("n") <= sets).select(*columns))
        blocks = F.ceil(F.col("n") * 2 / sets)
        found = found.unionByName(_in_blocks(sized.where(alike).withColumn("blocks", blocks), "bucket").select(*columns))
        counts = counts.where((F.col("n") > sets) & ~alike)
        large = parts.drop("before").join(counts, of_bucket).select(*columns, "n")
    return found, written


def _in_blocks(members: DataFrame, group: str) -> DataFrame:
    """Every set once for each pair of blocks of its group that its own block is
    in: bucket (the pair), and whether it is in the first or second of them."""
    own = F.pmod(F.xxhash64("key", F.lit(SEED)), F.col("blocks"))
    return (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("bucket", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("left", F.col("own") <= F.col("other"))
        .withColumn("right", F.col("own") >= F.col("other"))
    )


def _occurrences(sets: list[np.ndarray], common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the n-grams in ``common``, their places there in ascending order and their sets."""
    ids = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.searchsorted(common, ids)
    ok = at < len(common)
    ok[ok] = common[at[ok]] == ids[ok]
    order = np.argsort(at[ok], kind="stable")
    return at[ok][order], owner[ok][order]


def shared_ngrams(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """Number of n-grams that each of the sets ``a`` shares with each of ``b``
    (None: with each other of ``a``; the diagonal then has no meaning)."""
    if b is None:
        ids, counts = np.unique(np.concatenate(a), return_counts=True)
        common, b = ids[counts > 1], a
    else:
        common = np.intersect1d(np.concatenate(a), np.concatenate(b))
    shape = (len(a), len(b))
    out = np.zeros(shape, np.float32)
    if not len(common):
        return out
    found = [_occurrences(a, common)]
    found.append(found[0] if b is a else _occurrences(b, common))
    counts = [np.bincount(at, minlength=len(common)) for at, _ in found]
    pairs = counts[0] * counts[1]
    # N-grams of many sets go through matrix products, the others pair by pair.
    dense = pairs > max(1, DENSE * shape[0] * shape[1])
    number = np.cumsum(dense) - 1
    for low in range(0, int(dense.sum()), COLUMNS):
        parts = []
        for (at, of), n in zip(found, shape):
            here = dense[at] & (number[at] >= low) & (number[at] < low + COLUMNS)
            part = np.zeros((n, min(COLUMNS, int(dense.sum()) - low)), np.float32)
            part[of[here], number[at[here]] - low] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    (at_a, of_a), (at_b, of_b) = found
    first_b = np.cumsum(counts[1]) - counts[1]
    rare = np.flatnonzero(~dense[at_a])
    steps = np.cumsum(counts[1][at_a[rare]])
    low = 0
    while low < len(rare):
        high = max(low + 1, int(np.searchsorted(steps, (steps[low - 1] if low else 0) + (1 << 21))))
        chunk = rare[low:high]
        width = counts[1][at_a[chunk]]
        nth = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        other = of_b[np.repeat(first_b[at_a[chunk]], width) + nth]
        flat = np.repeat(of_a[chunk], width) * shape[1] + other
        out += np.bincount(flat, minlength=shape[0] * shape[1]).reshape(shape)
        low = high
    return out


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the sets on both sides of a comparison, and which pairs are similar."""
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    if not len(a) or not len(b):
        return a, b, np.zeros((len(a), len(b)), bool)
    lengths = np.array([len(x) for x in sets])
    same = np.array_equal(a, b)
    shared = shared_ngrams([sets[i] for i in a], None if same else [sets[i] for i in b])
    alike = shared + 1e-9 >= threshold * (lengths[a][:, None] + lengths[b] - shared)
    if same:
        np.fill_diagonal(alike, False)
    return a, b, alike


def _joined(a: np.ndarray, b: np.ndarray, alike: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` rows, the first that the similar pairs connect it with."""
    label = np.arange(n)
    while alike.any():
        new = label.copy()
        new[a] = np.minimum(new[a], np.where(alike, label[b], n).min(axis=1))
        new[b] = np.minimum(new[b], np.where(alike, label[a][:, None], n).min(axis=0))
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _could_hold(docs: DataFrame, holders: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose hash is that of a holder, and few others.

    A bitmap over the hashes of the holders, of a fixed size however many there
    are (FILTER_BITS bits, sent to all tasks), so that the texts of other rows
    need not be shuffled; with very many holders it lets more of them pass.
    """
    place = lambda c: F.pmod(F.col(c), F.lit(FILTER_BITS)) + 1
    bits = holders.select(place("row_hash").alias("p")).groupBy(F.bitmap_bucket_number("p").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
    at = F.bitmap_bit_position(place("row_hash"))
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    paged = docs.withColumn("page", F.bitmap_bucket_number(place("row_hash")))
    return paged.join(F.broadcast(bits), "page").where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*docs.columns)


def _partners(docs: DataFrame, members: DataFrame, ngram: int, threshold: float) -> DataFrame:
    """Written: key, linked (the summed n_copies of the sets of its group that are similar
    to it) and first (a set that links connect it with, or itself), a row for
    each comparison that finds a link.  members: key, root (the group), size,
    n_copies and holder, a row that has the set.

    Every block of a group meets every other once, and itself; the n-grams of a
    set are computed once.
    """
    weight = F.greatest(F.count("*"), F.ceil(F.sum("size") / COUNT_NGRAMS))
    blocks = members.groupBy(F.col("root").alias("s_root")).agg(F.ceil(weight / COUNT_SETS).alias("blocks"))
    blocks = materialise(blocks, "jaccard-groups")
    holders = members.join(blocks, F.col("root") == F.col("s_root")).select("holder.doc_id", "holder.row_hash", "key", "root", "blocks", "n_copies")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # rows that repeat one id and text
        for batch in rows(batches):
            new = []
            for i, key in enumerate(batch.column(0).to_pylist()):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            sets = [ngram_set(x.split(), ngram).tobytes() for x in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sets, pa.binary())], ["key", "root", "blocks", "n_copies", "ngrams"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            keys = table.column("key").to_pylist()
            new = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            if len(new) < len(keys):
                table, keys = table.take(new), [keys[i] for i in new]
            sets = [np.frombuffer(x, np.uint64) for x in table.column("ngrams").to_pylist()]
            copies = table.column("n_copies").to_numpy()
            a, b, alike = _links(sets, table.column("left").to_numpy(), table.column("right").to_numpy(), threshold)
            if not alike.any():
                continue
            linked = np.zeros(len(sets), np.int64)
            if not np.array_equal(a, b):
                linked[b] = copies[a] @ alike
            linked[a] += alike @ copies[b]
            first = _joined(a, b, alike, len(sets))
            some = np.flatnonzero(linked).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i in some], pa.binary()),
                    pa.array(linked[some]),
                    pa.array([keys[first[i]] for i in some], pa.binary()),
                ],
                ["key", "linked", "first"],
            )

    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.row_hash") == F.col("h.row_hash"))
    sets = (
        _could_hold(docs, holders).alias("d")
        .join(holders.alias("h"), same)
        .select("h.key", "h.root", "h.blocks", "h.n_copies", "d.text")
        .mapInArrow(packed, "key binary, root binary, blocks long, n_copies long, ngrams binary")
    )
    compared = (
        _in_blocks(sets, "root")
        .select("bucket", "key", "n_copies", "left", "right", "ngrams")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "key")
        .mapInArrow(count, "key binary, linked long, first binary")
    )
    links = materialise(compared, "jaccard-links")
    discard(blocks)
    return links


def _with_roots(edges: DataFrame) -> DataFrame:
    """g_key and root of every end of an edge."""
    found = components(edges)
    both = found.unionByName(found.select(F.col("root").alias("vertex"), "root").distinct()).withColumnRenamed("vertex", "g_key")
    return hand_over(found, both)


def join_documents(
    docs: DataFrame,
    ngram: int = NGRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    bucket_sets: int = BUCKET_SETS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_hash, class_id, n_copies, n_links
    and keeper.

    class_id is the smallest doc_id of the documents that links connect, itself
    included; n_copies counts the rows with an equal set of n-grams, itself
    included, and n_links its links: its other copies, and the rows of the
    classes similar to its own, however large its group.  keeper marks the first
    row, by (doc_id, row_hash), of a group; a row repeated in both marks all its
    repeats.

    A text of fewer words than ``ngram`` is one n-gram; one without words (or
    null) is a group of its own.  Null ids come last.  Other columns are ignored.
    """
    # Of the pairs that share the bucket of a run, a split keeps some together.
    # No number of runs makes up for splits that keep none.
    runs = runs_for(recall, threshold * (kept_together(threshold) if threshold * SPLITS > 1 else 1))
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash(text_column()).alias("row_hash"),
        text_column().cast("binary").alias("text"),
    )
    signed = materialise(_signatures(plain, ngram, runs), "jaccard-signatures")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_hash")
    known = signed.where(F.col("key").isNotNull())
    # Equal sets have equal sketches.
    of_set = [F.any_value(c).alias(c) for c in ("size", "sketch", "roots")]
    classes = known.groupBy("key").agg(F.count("*").alias("n_copies"), F.min(order).alias("holder"), *of_set)
    classes = materialise(classes, "jaccard-classes")
    buckets, read = _bucketed(classes, bucket_sets)
    candidates = materialise(_candidates(buckets, threshold), "jaccard-candidates")
    discard(*read)
    groups = _with_roots(candidates)
    members = groups.join(classes, F.col("g_key") == F.col("key")).select("key", "root", "size", "n_copies", "holder")
    members = materialise(members, "jaccard-members")
    discard(candidates, groups)
    links = _partners(plain, members, ngram, threshold)
    discard(members)
    linked = links.groupBy(F.col("key").alias("l_key")).agg(F.sum("linked").alias("linked"))
    joined = _with_roots(links.where("key <> first").select(F.col("key").alias("a"), F.col("first").alias("b")))
    copies = classes.select(F.col("key").alias("c_key"), "n_copies", "holder")
    firsts = (
        joined.join(copies, F.col("g_key") == F.col("c_key"))
        .groupBy(F.col("root").alias("f_root"))
        .agg(F.min("holder").alias("first"))
    )
    grouped = joined.join(spread(firsts), F.col("root") == F.col("f_root")).select("g_key", "first")
    verdicts = (
        copies.join(linked, F.col("c_key") == F.col("l_key"), "left")
        .join(grouped, F.col("c_key") == F.col("g_key"), "left")
        .select("c_key", "n_copies", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("first", "holder").alias("first"))
    )
    found = known.join(spread(verdicts), F.col("key") == F.col("c_key")).select(
        "doc_id",
        "row_hash",
        F.col("first.doc_id").alias("class_id"),
        F.col("n_copies").cast("long").alias("n_copies"),
        (F.col("n_copies") - 1 + F.col("linked")).cast("long").alias("n_links"),
        (F.col("first") == order).alias("keeper"),
    )
    alone = signed.where(F.col("key").isNull()).select(
        "doc_id",
        "row_hash",
        F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("n_copies"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("keeper"),
    )
    return found.unionByName(alone)
