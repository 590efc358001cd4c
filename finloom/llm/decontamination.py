"""Benchmark decontamination: Wu-Manber search for all windows of a benchmark.

A window is ten consecutive words of an item; an item of fewer words is one
window.  The search looks at blocks of three words.  A block that no window
holds lets it skip as many words as a window can't reach over; a block inside
windows skips to where the nearest of them would end; a block that ends windows
selects, by its hash and that of the first block, the few windows that are then
compared word by word.

Windows are dealt into blocks of bounded size, written to the shared folder;
a task holds one block and streams documents past it.  Texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.llm.ascii_words import as_bytes, overlapping
from finloom.llm.common import discard, filesystem, materialise, rows, spread, text_hash
from finloom.storage import folder

#: Words of a window, and of the blocks that the search looks at.
WINDOW, BLOCK = 10, 3
#: Pairs of a window and an item in a block of windows (some 40 MB in a task).
BLOCK_PAIRS = 100_000

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Searcher:
    """Shift tables and buckets for windows that are alike in length or short."""

    def __init__(self, windows: list[list[bytes]]):
        self.windows = windows
        self.least = min(map(len, windows))
        self.block = min(BLOCK, self.least)
        self.far = self.least - self.block + 1
        self.shifts: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[int]]] = {}
        for number, window in enumerate(windows):
            for end in range(self.block, self.least + 1):
                block = b" ".join(window[end - self.block : end])
                self.shifts[block] = min(self.shifts.get(block, self.far), self.least - end)
            self.buckets.setdefault(block, {}).setdefault(b" ".join(window[: self.block]), []).append(number)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Start, end and number of every window that occurs, by start."""
        width, least, far, shift_of, join = self.block, self.least, self.far, self.shifts.get, b" ".join
        end, n = least, len(words)
        while end <= n:
            block = join(words[end - width : end])
            shift = shift_of(block, far)
            if shift:
                end += shift
                continue
            start = end - least
            for number in self.buckets[block].get(join(words[start : start + width]), ()):
                window = self.windows[number]
                if words[start : start + len(window)] == window:
                    yield start, start + len(window), number
            end += 1


class Matcher:
    """Searchers for a set of windows: one for full windows, one for short ones."""

    def __init__(self, windows: Iterable[tuple[bytes, list[str]]], full: int):
        self.full = full
        self.items: dict[int, list[list[str]]] = {0: [], 1: []}
        lists: dict[int, list[list[bytes]]] = {0: [], 1: []}
        for window, items in windows:
            words = window.split()
            kind = int(len(words) < full)
            lists[kind].append(words)
            self.items[kind].append(items)
        self.searchers = {kind: Searcher(found) for kind, found in lists.items() if found}

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, hit spans (merged, end exclusive) and items of a text."""
        n_words, spans, found = 0, [], {kind: set() for kind in self.searchers}
        for at, known, words in overlapping(text, self.full - 1):
            n_words += len(words) - known
            for kind, searcher in self.searchers.items():
                for start, end, number in searcher.find(words):
                    found[kind].add(number)
                    if spans and start + at <= spans[-1][1] and start + at >= spans[-1][0]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], end + at))
                    else:
                        spans.append((start + at, end + at))
        items = sorted(set(chain.from_iterable(self.items[kind][i] for kind, numbers in found.items() for i in numbers)))
        return n_words, merged(spans), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """window (words joined by a space) and item_id (as string), each pair once."""

    def pairs(item: str | None, found: set[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([item] * len(found), pa.string())], ["window", "item_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches, 64):
            for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                words, short = [], True
                for _, _, words in overlapping(text, window - 1, 1 << 16):
                    if len(words) >= window:
                        short = False
                        yield pairs(item, {b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)})
                if words and short:
                    yield pairs(item, {b" ".join(words)})

    picked = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(cut, "window binary, item_id string").distinct()


@lru_cache(maxsize=1)
def _matcher(path: str, block: int, full: int) -> Matcher:
    fs, place = filesystem(path)
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(place)) if f.path.endswith(".parquet")]
    table = pads.dataset(files, filesystem=fs, format="parquet").to_table(columns=["window", "items"], filter=pads.field("block") == block)
    return Matcher(zip(*(c.to_pylist() for c in table.columns)), full)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, columns: tuple[str, ...] = ("doc_id",), block_pairs: int = BLOCK_PAIRS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row (a struct of the input's
    ``columns``), n_words, spans (word positions inside occurrences of windows,
    merged, end exclusive) and items (ids of the items whose windows occur, as
    strings, in order).

    Null texts have no words, in both tables.  An item without words has no
    window; one with fewer words than a window is one.  Rows of the benchmark
    that share an id are one item; a null id is in no list, its windows are
    searched for.  Repeated documents get equal rows; other columns are ignored,
    whatever their names.
    """
    spark = docs.sparkSession
    pairs = materialise(benchmark_windows(benchmark, window), "decontamination-pairs")
    n_blocks = max(1, -(-pairs.count() // block_pairs))
    # The list of a window's items is a part of the answer for every document that holds it.
    windows = pairs.groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    placed = windows.select("window", "items", F.pmod(F.xxhash64("window"), F.lit(n_blocks)).cast("int").alias("block"))
    path = folder(materialise(placed.repartition(n_blocks, "block").sortWithinPartitions("block"), "decontamination-windows"))
    discard(pairs)

    plain = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.struct(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row_hash")).alias("id"),
        F.col("text").cast("string").alias("text"),
    )
    names = ["row", "id", "n_words", "spans", "items"]
    found_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType(
        [plain.schema["row"], plain.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("spans", found_type), T.StructField("items", T.ArrayType(T.StringType()))]
    )

    def search(block: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows(batches):
                n_words, spans, items = zip(*map(_matcher(path, block, window).scan, as_bytes(batch.column(2))))
                spans = [[{"start": a, "end": b} for a, b in x] for x in spans]
                arrays = [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names)

        return plain.mapInArrow(run, schema)

    first = search(0)
    if n_blocks == 1:
        return first.select("row", "n_words", "spans", "items")
    others = [search(b).where("size(spans) > 0").select("id", "spans", "items").distinct() for b in range(1, n_blocks)]
    more = others[0]
    for other in others[1:]:
        more = more.unionByName(other)
    more = more.groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    both = first.alias("f").join(spread(more).alias("m"), F.col("f.id").eqNullSafe(F.col("m.id")), "left")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            spans = [merged((s["start"], s["end"]) for s in (a or []) + (b or [])) for a, b in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())]
            items = [sorted({*(a or ()), *(b or ())}) for a, b in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist())]
            arrays = [pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], ["row", "n_words", "spans", "items"])

    merged_schema = T.StructType([f for f in schema if f.name != "id"])
    return both.select("row", "n_words", "spans", "items", "more_spans", "more_items").mapInArrow(join, merged_schema)
