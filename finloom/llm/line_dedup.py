"""Line dedup over overlapping three-line windows.

A window is three consecutive lines of a document (texts cut at line feeds).
Among equal windows the first by (doc_id, row hash, line number) stays; every
later one marks its three lines, and lines with a mark are removed.  A removed
line always survives earlier, so nothing disappears altogether.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import spread, text_column, text_hash

WINDOW = 3


def _identified(docs: DataFrame) -> DataFrame:
    """The input row in one struct, so that its column names can't clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row",
        F.col("row.doc_id").cast("long").alias("doc_id"),
        text_column("row.text").alias("text"),
        text_hash(text_column("row.text")).alias("row_hash"),
    )


def line_windows(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, line (number of the first line) and key of every window.

    Lines are hashed first and windows over the hashes of their lines; both
    with 128 bits, so that windows of a large corpus don't collide.
    """
    return (
        docs.select("doc_id", "row_hash", F.expr("transform(split(text, '\n', -1), x -> unhex(md5(x)))").alias("h"))
        .where(F.size("h") >= WINDOW)
        .select(
            "doc_id",
            "row_hash",
            F.expr(
                f"inline(transform(sequence(0, size(h) - {WINDOW}), i -> "
                "named_struct('line', i, 'key', unhex(md5(concat(h[i], h[i + 1], h[i + 2]))))))"
            ),
        )
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row (the input row), n_lines, n_removed, kept_text.

    Null text counts as empty; an empty text is one empty line, and texts of
    fewer than three lines stay whole.  Null ids sort first.  Rows that repeat
    one id and text are one document and get equal results.  All columns of
    the input, whatever their names, are inside ``row``.
    """
    identified = _identified(docs)
    windows = line_windows(identified)
    # Partial aggregation comes before the shuffle, so a window that a third of
    # all rows hold arrives as one row a task.
    firsts = (
        windows.groupBy("key")
        .agg(F.min(F.struct("doc_id", "row_hash", "line")).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select(F.col("key").alias("first_key"), "first")
    )
    # A hot key has one row on the right; dealt evenly first, so that adaptive
    # execution can split the left.
    starts = (
        windows.join(spread(firsts), F.col("key") == F.col("first_key"))
        .where(F.struct("doc_id", "row_hash", "line") != F.col("first"))
        .groupBy("doc_id", "row_hash")
        .agg(F.sort_array(F.collect_set("line")).alias("starts"))
        .select(F.col("doc_id").alias("s_doc_id"), F.col("row_hash").alias("s_row_hash"), "starts")
    )
    same_row = F.col("doc_id").eqNullSafe(F.col("s_doc_id")) & (F.col("row_hash") == F.col("s_row_hash"))
    lines = F.expr("split(text, '\n', -1)")
    # Between covered stretches: from the end of one marked window to the start
    # of the next, where that is not empty.
    stretches = f"""filter(transform(sequence(0, size(starts)), i -> named_struct(
        'from', if(i = 0, 0, get(starts, i - 1) + {WINDOW}),
        'to', if(i = size(starts), size(lines), get(starts, i)))), g -> g.to > g.from)"""
    return (
        identified.join(spread(starts), same_row, "left")
        .select("row", "text", lines.alias("lines"), "starts")
        .select("row", "text", "lines", "starts", F.expr(stretches).alias("stretches"))
        .select(
            "row",
            F.size("lines").cast("long").alias("n_lines"),
            F.expr(
                "if(starts IS NULL, 0L, size(lines) - aggregate(stretches, 0L, (a, g) -> a + g.to - g.from))"
            ).alias("n_removed"),
            F.expr(
                "if(starts IS NULL, text, "
                "array_join(flatten(transform(stretches, g -> slice(lines, g.from + 1, g.to - g.from))), '\n'))"
            ).alias("kept_text"),
        )
    )
