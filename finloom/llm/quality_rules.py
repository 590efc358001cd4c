"""Quality rules with cross-document line frequency.

A document passes through two kinds of rule.  The base rules look at the
document alone (length, repeated three-word windows).  The frequency rule looks
at the corpus: every distinct normalised line of a document is hashed, the
distinct documents holding it are counted per host, lines above the limit are
removed as boilerplate, and a document that keeps too little is rejected as
depleted.

Copies of a text count as one document, so a text that was merely copied often
does not turn its own lines into boilerplate.

Texts are read twice, for their lines and for the verdicts, and never shuffled
(unless there are very many lines above the limit).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.llm.common import discard, materialise, rows, spread, text_column, text_hash

#: Shortest document, in words, and the largest share of words in repeated
#: three-word windows, in per cent.
MIN_WORDS, MAX_REPEATED_PCT = 50, 50
#: A line is boilerplate if more than this share of a host's distinct documents
#: hold it, and more than this number of them.
LINE_SHARE, LINE_DOCS = 0.1, 20
#: A document is depleted if less than this share of its words is left.
MIN_LEFT_SHARE = 0.5

#: With no more lines above the limit than this their table (some tens of MB) is
#: broadcast; with more, texts are joined with it by a shuffle.
BROADCAST_LINES = 1_000_000
#: Hosts whose lines a task remembers before it starts anew.
CACHED_HOSTS = 1000

_SYMBOLS = "#*$%&|<>"


def _repeated_words(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur at least twice."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    covered, end = 0, 0
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def _code_points(raw: bytes) -> int:
    return len(raw) if raw.isascii() else len(raw.decode())


def _line_key(parts: list[bytes]) -> int:
    key = xxhash.xxh64_intdigest(b" ".join(parts).decode().lower().encode())
    return key - ((key >> 63) << 64)


def line_keys(text: str) -> set[int]:
    """Hashes of the distinct normalised lines of a text.

    A line is normalised by lower-casing it and joining its words with one
    space; lines without a word are left out.
    """
    parted = (line.split() for line in text.encode().split(b"\n"))
    return {_line_key(parts) for parts in parted if parts}


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows(batches):
        keys = [list(line_keys(x)) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keys, pa.list_(pa.int64()))], ["host", "row_hash", "lines"])


def text_features(text: str, gone: set[int]) -> tuple[int, int, int, int, int, int, str]:
    """Words, their code points, symbols, repeated lines, words in repeated
    windows, words in the lines whose hashes are ``gone``, and the text without
    those lines."""
    raw = text.encode()
    words = raw.split()
    seen: set[bytes] = set()
    repeated = gone_words = 0
    kept: list[bytes] = []
    for line in raw.split(b"\n"):
        parts = line.split()
        if parts:
            repeated += line in seen
            seen.add(line)
            if gone and _line_key(parts) in gone:
                gone_words += len(parts)
                continue
        kept.append(line)
    return (
        len(words),
        _code_points(b"".join(words)),
        sum(map(text.count, _SYMBOLS)),
        repeated,
        _repeated_words(words),
        gone_words,
        b"\n".join(kept).decode() if gone_words else text,
    )


def boilerplate_lines(docs: DataFrame, line_share: float = LINE_SHARE, line_docs: int = LINE_DOCS) -> DataFrame:
    """host and gone, the hashes of its lines above the limit; docs: host, row_hash, text.

    A host has few of them, however many documents it has: a line takes the
    stated share of its texts, which hold so many distinct lines on average.
    """
    lines = materialise(docs.mapInArrow(_key_batches, "host string, row_hash long, lines array<long>"), "quality-lines")
    # Counts of distinct texts; both steps combine before their shuffle, so
    # neither a line that all documents hold nor a host with most rows is hot.
    each = lines.select("host", "row_hash", F.explode("lines").alias("hash")).distinct()
    line_counts = each.groupBy("host", "hash").agg(F.count("*").alias("line_docs")).where(F.col("line_docs") > line_docs)
    host_counts = lines.select("host", "row_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    common = (
        spread(line_counts)
        .alias("c")
        .join(spread(host_counts).alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
        .where(F.col("c.line_docs") > line_share * F.col("h.host_docs"))
    )
    of_host = materialise(common.groupBy("c.host").agg(F.collect_list("c.hash").alias("gone")), "quality-common")
    discard(lines)
    return of_host


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words"))


def quality_verdicts(
    docs: DataFrame,
    host: str = "source",
    line_share: float = LINE_SHARE,
    line_docs: int = LINE_DOCS,
    min_left_share: float = MIN_LEFT_SHARE,
    columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the column ``host``).

    Returns row (a struct of the input's ``columns``), n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_boilerplate_words, kept_text (the
    text without its lines above the limit), base_failed and kept.

    Null text: no words, so base_failed.  Null host: a host of its own.
    Repeated rows get one verdict each, all alike.  Other columns are ignored,
    whatever their names.
    """
    plain = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(host).cast("string").alias("host"),
        text_hash(text_column()).alias("row_hash"),
        text_column().alias("text"),
    )
    common = boilerplate_lines(plain.select("host", "row_hash", "text"), line_share, line_docs)
    n_lines = common.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0]
    common = common.withColumnRenamed("host", "c_host")
    if n_lines <= BROADCAST_LINES:
        common = F.broadcast(common)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_boilerplate_words")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_host: dict[str | None, set[int]] = {}
        for batch in rows(batches):
            gone = batch.column(3)
            found = []
            for i, (name, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if name not in of_host:
                    if len(of_host) >= CACHED_HOSTS:
                        of_host.clear()
                    of_host[name] = set(gone[i].as_py() or ())
                found.append(text_features(text, of_host[name]))
            *numbers, kept = zip(*found)
            arrays = [*(pa.array(x, pa.int64()) for x in numbers), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["row", *counts, "kept_text"])

    schema = T.StructType([plain.schema["row"], *(T.StructField(c, T.LongType()) for c in counts), T.StructField("kept_text", T.StringType())])
    return (
        plain.join(common, F.col("host").eqNullSafe(F.col("c_host")), "left")
        .select("row", "host", "text", "gone")
        .mapInArrow(judge, schema)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_boilerplate_words") >= min_left_share * F.col("n_words")))
    )
