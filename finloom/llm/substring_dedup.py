"""Substring dedup by super-k-mer partitioning.

A window is a fixed number of consecutive words.  The minimiser of a window is
the smallest hash of its short word runs, so equal windows have equal
minimisers; consecutive windows that share one form a super-k-mer.  A window
can only repeat if its minimiser does, so minimisers are counted first, and the
super-k-mers of repeated ones travel, each as one packed string, to the bucket
of their minimiser.  There the windows are sorted, which counts them exactly.

A bucket of more strings than BUCKET_STRINGS would be a hot task.  Its distinct
strings are spread out instead, cut into windows, and counted by an aggregation
that combines before its shuffle; the result is the same.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import discard, materialise, rows, spread, text_column, text_hash

#: Words of a window and of the runs that a minimiser is chosen from.
WINDOW, RUN = 35, 8
#: A longer super-k-mer is cut, windows of one string at most.
STRING_WINDOWS = 64
#: Strings of a minimiser that one task compares.
BUCKET_STRINGS = 1000
#: Words whose hashes a worker remembers before it starts anew.
CACHED_WORDS = 500_000
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Bytes of texts that are hashed at once, and of a word that are hashed with others.
HASHED_BYTES, LONG_WORD = 1 << 18, 256
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False
_POWERS = np.cumprod(np.full(LONG_WORD + 1, _MUL, np.uint64))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, run: int) -> np.ndarray:
    """A well mixed hash of every ``run`` consecutive words."""
    n = max(0, len(hashes) - run + 1)
    total = np.zeros(n, np.uint64)
    for j in range(run):
        total = total * _MUL + hashes[j : j + n]
    total = (total ^ (total >> np.uint64(31))) * _MIX
    return total ^ (total >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of every ``width`` consecutive values and its first place."""
    have = 1
    low, place = values, np.arange(len(values))
    while have < width:
        step = min(have, width - have)
        later = low[step:] < low[: len(low) - step]
        place = np.where(later, place[step:], place[: len(place) - step])
        low = np.where(later, low[step:], low[: len(low) - step])
        have += step
    return low, place


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after another, and the number of words
    of each.  About HASHED_BYTES of texts are hashed at once, as polynomials of the
    words' bytes (which takes arrays of some fifty times as much); words of over
    LONG_WORD bytes one by one."""
    hashes, counts, held, size = [], [], [], 0

    def close() -> None:
        nonlocal held, size
        if held:
            found, n = _hash_joined(held)
            hashes.append(found)
            counts.append(n)
            held, size = [], 0

    for text in texts:
        if size + len(text) > HASHED_BYTES:
            close()
        if len(text) > HASHED_BYTES:
            parts = [_hash_joined([x])[0] for x in _slices(text)]
            hashes += parts
            counts.append(np.array([sum(map(len, parts))]))
        else:
            held.append(text)
            size += len(text) + 1
    close()
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def _slices(text: bytes) -> Iterator[bytes]:
    """A long text cut between words."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + HASHED_BYTES)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _hash_joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = b" ".join([*texts, b""])
    raw = np.frombuffer(joined, np.uint8)
    inside = _INSIDE[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    ends_of_texts = np.cumsum([len(x) + 1 for x in texts])
    counts = np.diff(np.searchsorted(starts, ends_of_texts), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = ends - starts
    hashes = np.empty(len(starts), np.uint64)
    short = lengths <= LONG_WORD
    for i in np.flatnonzero(~short):
        hashes[i] = _hash_word(joined[starts[i] : ends[i]])
        inside[starts[i] : ends[i]] = False
    lengths = lengths[short]
    if len(lengths):
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        terms = (raw[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place]
        hashes[short] = _mixed(np.add.reduceat(terms, first), lengths)
    return hashes, counts


def _mixed(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    sums = (sums ^ (sums >> np.uint64(32)) ^ (lengths.astype(np.uint64) << np.uint64(48))) * _MIX
    return sums ^ (sums >> np.uint64(29))


def _hash_word(word: bytes) -> int:
    """The hash of one word, as ``_hash_joined`` has it."""
    if len(word) > LONG_WORD:
        return xxhash.xxh3_64_intdigest(word)
    raw = np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1)
    return int(_mixed(np.array([(raw * _POWERS[: len(raw)]).sum()], np.uint64), np.array([len(raw)]))[0])


def super_kmers(hashes: np.ndarray, lengths: np.ndarray, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, ...]:
    """Super-k-mers of texts given by the hashes of their words and their numbers
    of words: the number of the text, the minimiser, the first word, the number
    of windows, and whether the minimiser has several places, so that windows of
    this one may be equal."""
    if len(hashes) < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, bool))
    low, place = _sliding_min(run_hashes(hashes, run), window - run + 1)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    whole = np.flatnonzero(text_of[: len(low)] == text_of[window - 1 :])
    if not len(whole):
        return super_kmers(hashes[:0], lengths[:0], window, run)
    low, place = low[whole], place[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (low[1:] != low[:-1]) | (whole[1:] != whole[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(whole)))
    several = place[first] != place[first + count - 1]
    pieces = -(-count // STRING_WINDOWS)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + nth * STRING_WINDOWS
    count = np.minimum(np.repeat(count, pieces) - nth * STRING_WINDOWS, STRING_WINDOWS)
    at = whole[first]
    return text_of[at], low[first], at - starts[text_of[at]], count, np.repeat(several, pieces)


def repeated_windows(strings: list[tuple[bytes, int]], window: int = WINDOW) -> dict[bytes, list[int]]:
    """Of packed strings with their numbers of occurrences: for each string, the
    first words of its windows that occur twice or more among all of them."""
    found: list[tuple[bytes, int, int]] = []
    for i, (packed, _) in enumerate(strings):
        words = packed.split(b" ")
        found += [(b" ".join(words[j : j + window]), i, j) for j in range(len(words) - window + 1)]
    found.sort()
    out: dict[bytes, list[int]] = {}
    at = 0
    while at < len(found):
        end = at + 1
        while end < len(found) and found[end][0] == found[at][0]:
            end += 1
        if end - at > 1 or strings[found[at][1]][1] > 1:
            for _, i, j in found[at:end]:
                out.setdefault(strings[i][0], []).append(j)
        at = end
    return out


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    """Ascending numbers as stretches (first, how many)."""
    out: list[tuple[int, int]] = []
    for x in starts:
        if out and x == out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((x, 1))
    return out


_STRETCHES = "doc_id long, row_hash long, first int, windows int"
_STRETCH_NAMES = ["doc_id", "row_hash", "first", "windows"]


def _stretch_batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(kinds)], _STRETCH_NAMES)


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.row_hash") == F.col(f"{b}.row_hash"))


def _bucket_counts(strings: DataFrame, window: int) -> DataFrame:
    """Repeated windows of buckets that one task compares at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[tuple]] = {}
        now = None
        found: list[tuple] = []

        def close() -> None:
            distinct = [(k, len(v)) for k, v in held.items()]
            for packed, starts in repeated_windows(distinct, window).items():
                for first, n in _runs(sorted(starts)):
                    found.extend((doc_id, row_hash, at + first, n) for doc_id, row_hash, at in held[packed])

        for batch in batches:
            for minimiser, packed, *place in zip(*(c.to_pylist() for c in batch.columns)):
                if minimiser != now:
                    close()
                    held.clear()
                    now = minimiser
                    if len(found) >= 20_000:
                        yield _stretch_batch(found)
                        found.clear()
                held.setdefault(packed, []).append(tuple(place))
        close()
        if found:
            yield _stretch_batch(found)

    return (
        strings.select("minimiser", "packed", "doc_id", "row_hash", "start")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(count, _STRETCHES)
    )


def _spread_counts(strings: DataFrame, window: int) -> DataFrame:
    """Repeated windows of hot buckets: equal strings meet once, their windows
    are counted by 128-bit digests with partial sums."""
    strings = strings.withColumn("string", F.unhex(F.md5("packed")))
    distinct = strings.groupBy("packed", "string").agg(F.count("*").alias("n"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["string", "n", "offset", "digest"]
        for batch in rows(batches, 2048):
            found = []
            for packed, string, n in zip(*(c.to_pylist() for c in batch.columns)):
                words = packed.split(b" ")
                for j in range(len(words) - window + 1):
                    found.append((string, n, j, hashlib.md5(b" ".join(words[j : j + window])).digest()))
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(kinds)], names)

    windows = materialise(
        distinct.mapInArrow(cut, "string binary, n long, offset int, digest binary"), "substring-windows"
    )
    repeated = materialise(
        windows.groupBy("digest").agg(F.sum("n").alias("total")).where("total > 1").select(F.col("digest").alias("r_digest")),
        "substring-repeated",
    )
    # A string has few windows: they become stretches before its occurrences,
    # which may be very many, are looked up.
    offsets = (
        windows.join(repeated, F.col("digest") == F.col("r_digest"))
        .groupBy(F.col("string").alias("o_string"))
        .agg(F.array_sort(F.collect_set("offset")).alias("offsets"))
        .withColumn("firsts", F.filter("offsets", lambda x: ~F.array_contains("offsets", x - 1)))
        .withColumn("lasts", F.filter("offsets", lambda x: ~F.array_contains("offsets", x + 1)))
        .select("o_string", F.zip_with("firsts", "lasts", lambda a, b: F.struct(a.alias("offset"), (b - a + 1).alias("windows"))).alias("found"))
    )
    joined = strings.join(spread(offsets), F.col("string") == F.col("o_string"))
    return joined.select("doc_id", "row_hash", "start", F.inline("found")).select(
        "doc_id", "row_hash", (F.col("start") + F.col("offset")).cast("int").alias("first"), F.col("windows").cast("int").alias("windows")
    )


def dedup_substrings(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and kept_text.

    Every word is removed that a window covers whose words also start anywhere
    else, the same document included; kept words are joined by one space.  Null
    text has no words.  Rows that repeat one id and text repeat each other's
    windows, and get equal results.  Other columns are ignored.
    """
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash(text_column()).alias("row_hash"),
        text_column().cast("binary").alias("text"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Texts are shuffled compressed: they are the bulk of what moves.
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in rows(batches):
            packed = pa.array([compressor.compress(x) for x in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed], ["doc_id", "row_hash", "packed_text"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_hash", "minimiser", "start", "n_windows", "several"]
        for batch in rows(batches):
            text, minimiser, start, n, several = super_kmers(*hash_texts(batch.column(2).to_pylist()), window, run)
            at = pa.array(text)
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(minimiser.view(np.int64))]
            columns += [pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(several)]
            yield pa.RecordBatch.from_arrays(columns, names)

    packed = plain.mapInArrow(pack, "doc_id long, row_hash long, packed_text binary")
    # Written, as they are counted and then joined with the counts.
    found = materialise(
        plain.mapInArrow(places, "doc_id long, row_hash long, minimiser long, start int, n_windows int, several boolean"),
        "substring-places",
    )
    # Written, so that adaptive execution can split the join where a minimiser is hot.
    counts = materialise(
        found.groupBy("minimiser")
        .agg(F.count("*").alias("n"), F.max("several").alias("several"))
        .where("n > 1 OR several")
        .select(F.col("minimiser").alias("c_minimiser"), "n"),
        "substring-minimisers",
    )
    # Places of one text travel together to fetch its words; rows that repeat one
    # id and text have the same places.
    wanted = (
        found.join(counts, F.col("minimiser") == F.col("c_minimiser"))
        .groupBy("doc_id", "row_hash")
        .agg(F.collect_set(F.struct("minimiser", "start", "n_windows", "n")).alias("places"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_hash", "minimiser", "start", "n", "packed"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        decompressor = zstandard.ZstdDecompressor()
        for batch in rows(batches, 256):
            out = []
            for doc_id, row_hash, text, wanted_places in zip(*(c.to_pylist() for c in batch.columns)):
                words = decompressor.decompress(text).split()
                for p in wanted_places:
                    start = p["start"]
                    string = b" ".join(words[start : start + p["n_windows"] + window - 1])
                    out.append((doc_id, row_hash, p["minimiser"], start, p["n"], string))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names)

    strings = materialise(
        packed.alias("d")
        .join(wanted.alias("w"), _same_row("d", "w"))
        .select("d.doc_id", "d.row_hash", "packed_text", "places")
        .mapInArrow(cut, "doc_id long, row_hash long, minimiser long, start int, n long, packed binary"),
        "substring-strings",
    )
    discard(found, counts)
    covered = (
        _bucket_counts(strings.where(F.col("n") <= BUCKET_STRINGS), window)
        .unionByName(_spread_counts(strings.where(F.col("n") > BUCKET_STRINGS), window))
        .distinct()
        .groupBy("doc_id", "row_hash")
        .agg(F.collect_list(F.struct("first", "windows")).alias("stretches"))
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "kept_text"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        decompressor = zstandard.ZstdDecompressor()
        for batch in rows(batches):
            out = []
            for doc_id, text, stretches in zip(*(c.to_pylist() for c in batch.columns)):
                words = decompressor.decompress(text).split()
                kept, end = words, 0
                if stretches:
                    kept = []
                    for first, n in sorted((s["first"], s["windows"]) for s in stretches):
                        kept += words[end:first]
                        end = max(end, first + n + window - 1)
                    kept += words[end:]
                out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names)

    return (
        packed.alias("d")
        .join(covered.alias("c"), _same_row("d", "c"), "left")
        .select("d.doc_id", "packed_text", "stretches")
        .mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_text string")
    )
