"""Importance resampling towards a target distribution.

Texts are described by hashed counts of words and pairs of words.  A bucket's
gain is the logarithm of how much more frequent it is in the target than in the
corpus, a text's weight the mean gain of its features, and documents are drawn
without replacement by weight and Gumbel noise.

Equal texts are collapsed first, by grouping the full text: features and weight
are computed once a text, counts are multiplied by the number of its copies,
and weights are joined back to documents before each gets noise of its own.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.ascii_words import FOLD, as_bytes, pieces
from finloom.llm.common import discard, materialise, rows, spread, text_column
from finloom.llm.numbering import numbered

#: Buckets of features; share drawn, in per cent; words of a document that may be drawn; seed of the noise.
BUCKETS, DRAWN_PCT, MIN_WORDS, SEED = 10_000, 25, 20, 7
#: Bytes of texts whose features are hashed at once (arrays of some forty times as much), and
#: of a word that is hashed with others.
HASHED_BYTES, LONG_WORD = 1 << 18, 48

# CRC-32 of one byte, reflected; 0xEDB88320 is the fixed polynomial.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)
_ONES = np.uint32(0xFFFFFFFF)


def _advance(register: np.ndarray, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of one word each, for all words together."""
    order = np.argsort(np.minimum(lengths, LONG_WORD + 1).astype(np.uint8), kind="stable")[::-1]
    n_long = int(np.count_nonzero(lengths > LONG_WORD))
    out = np.empty(len(register), np.uint32)
    for i in order[:n_long].tolist():
        word = raw[starts[i] : starts[i] + lengths[i]].tobytes()
        out[i] = zlib.crc32(word, int(register[i] ^ _ONES)) ^ 0xFFFFFFFF
    order = order[n_long:]
    at, left, state = starts[order], lengths[order], register[order]
    longer = len(order) - np.searchsorted(left[::-1], np.arange(LONG_WORD + 1), side="right")
    for k in range(int(left[0]) if len(left) else 0):
        n = longer[k]
        state[:n] = _CRC[(state[:n] ^ raw[at[:n] + k]) & 255] ^ (state[:n] >> np.uint32(8))
    out[order] = state
    return out


def _hash_joined(folded: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words and of pairs of words, with the number of the text of each."""
    raw = np.frombuffer(b" ".join([*folded, b""]), np.uint8)
    inside = raw != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    lengths = ends - starts
    text = np.searchsorted(np.cumsum([len(x) + 1 for x in folded]), starts, side="right")
    words = _advance(np.full(len(starts), _ONES, np.uint32), raw, starts, lengths)
    pair = np.flatnonzero(text[1:] == text[:-1])
    spaced = _CRC[(words[pair] ^ np.uint32(32)) & 255] ^ (words[pair] >> np.uint32(8))
    pairs = _advance(spaced, raw, starts[pair + 1], lengths[pair + 1])
    return (words ^ _ONES) % np.uint32(buckets), (pairs ^ _ONES) % np.uint32(buckets), text, text[pair]


def text_features(texts: list[bytes], buckets: int = BUCKETS) -> list[np.ndarray]:
    """The buckets of the features of every text, repeats included: its words, then its pairs."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def close() -> None:
        nonlocal held, size
        if held:
            words, pairs, of_word, of_pair = _hash_joined(held, buckets)
            numbers = np.arange(1, len(held))
            out.extend(map(np.concatenate, zip(np.split(words, np.searchsorted(of_word, numbers)), np.split(pairs, np.searchsorted(of_pair, numbers)))))
            held, size = [], 0

    for text in texts:
        if len(text) > HASHED_BYTES:
            close()
            out.append(_long_features(text, buckets))
            continue
        if size + len(text) > HASHED_BYTES:
            close()
        held.append(text.translate(FOLD))
        size += len(text)
    close()
    return out


def _long_features(text: bytes, buckets: int) -> np.ndarray:
    """By pieces; a piece starts with the last word of the one before, for the pair across."""
    words, pairs, last = [], [], b""
    for piece in pieces(text, HASHED_BYTES):
        if piece.strip():
            w, p, _, _ = _hash_joined([last + piece if last else piece], buckets)
            words.append(w[1:] if last else w)
            pairs.append(p)
            last = piece.rsplit(maxsplit=1)[-1]
    return np.concatenate([*words, *pairs]) if words else np.zeros(0, np.uint32)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows(batches, 128):
        found = text_features(as_bytes(batch.column(1)))
        packed = [x.astype("<u2").tobytes() for x in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["digest", "features", "copies"])


def collapsed(texts: DataFrame, label: str) -> DataFrame:
    """digest, features (two bytes each) and copies of every distinct text; null counts as empty."""
    grouped = texts.select(text_column().alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    features = grouped.select(text_digest().alias("digest"), "text", "copies").mapInArrow(
        _feature_batches, "digest binary, features binary, copies long"
    )
    return materialise(features, label)


def text_digest() -> Column:
    return F.unhex(F.sha2(text_column(), 256))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a bucket and task, whatever the number of features."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for features, copies in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total += copies * np.bincount(np.frombuffer(features, "<u2"), minlength=BUCKETS)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])


def bucket_gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket, in thousandths, from tables of ``collapsed``."""

    def counts(table: DataFrame) -> np.ndarray:
        found = table.select("features", "copies").mapInArrow(_count_batches, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
        total = np.zeros(BUCKETS, np.int64)
        for row in found.collect():  # BUCKETS rows at most, however large the table is
            total[row.bucket] = row.n
        return total

    of_corpus, of_target = counts(corpus), counts(target)
    all_corpus, all_target = float(of_corpus.sum() + BUCKETS), float(of_target.sum() + BUCKETS)
    odds = ((t + 1.0) * all_corpus / ((s + 1.0) * all_target) for s, t in zip(of_corpus.tolist(), of_target.tolist()))
    return np.array([math.floor(1000 * math.log(x)) for x in odds], np.int64)


def text_weights(corpus: DataFrame, gains: np.ndarray) -> DataFrame:
    """digest, n_features, weight of every distinct text."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            features = [np.frombuffer(x, "<u2") for x in batch.column(1).to_pylist()]
            n = [len(x) for x in features]
            weights = [int(gains[x].sum()) // len(x) if len(x) else 0 for x in features]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(weights, pa.int64())], ["digest", "n_features", "weight"])

    return corpus.select("digest", "features").mapInArrow(weigh, "digest binary, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the seed and the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, drawn_pct: int = DRAWN_PCT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score
    and rank (from 1, by falling score, then doc_id; null: not drawn).

    ``target`` has a column text.  Null texts have no words, a text without
    words weighs 0.  Of the N documents with ``min_words`` words or more,
    ``drawn_pct`` * N / 100 are drawn, rounded down.  Rows that repeat an id and
    a text are documents of equal score, of which any comes first; a null id is
    the smallest and has the noise of an empty one.  No documents, no rows.
    Other columns are ignored.
    """
    corpus, wanted = collapsed(docs, "importance-texts"), collapsed(target, "importance-target")
    weights = materialise(text_weights(corpus, bucket_gains(corpus, wanted)), "importance-weights")
    discard(corpus, wanted)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
    scored = materialise(
        named.join(spread(weights), "digest").select("doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), F.spark_partition_id().alias("dealt")),
        "importance-scores",
    )
    discard(weights)
    # w words make w pairs but one.
    may = F.col("n_features") >= 2 * min_words - 1
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("dealt")]
    ranked = numbered(scored.where(may), [], order, "importance-ranks")
    drawn = F.when(F.col("position") < F.floor(F.col("n") * drawn_pct / 100), F.col("position") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~may).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, drawn.alias("rank")).unionByName(rest)
