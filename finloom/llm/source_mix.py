"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words and so each of its documents the same
expected number of copies.  The whole part is certain; the fractional parts are
rounded pair by pair: words move at random from one document's fraction to the
other's until one of the two is 0 or 1, in such proportion that expectations
hold and the words of the pair stay what they were.  Pairs are met inside
blocks of few documents; what a block leaves over, one fraction, goes on to the
next level of a reduction tree, until one fraction a source is left.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from finloom.llm.common import WORD, discard, hand_over, materialise, spread, text_column, text_hash

WEIGHTS, SHARE, MAX_COPIES = (5, 2, 1), 1.5, 2
#: Documents of a block on average, and the seed of the random choices.
BLOCK, SEED = 64, 20240101
#: With no more sources than this their table (under 1 MB) is broadcast; with
#: more, it is joined by a shuffle that adaptive execution splits where hot.
BROADCAST_SOURCES = 10_000
#: Rows of one id and text that are numbered at a time.
REPEATS = 1_000_000

_ITEM = "doc_id long, row_hash long, size long, h long, p double"
_DONE = "doc_id long, row_hash long, size long, copies int"


def _ranked(totals: DataFrame) -> DataFrame:
    """``totals`` with rank: the place of the source by code point, null last.

    Range partitions are numbered inside and shifted by the sizes of those
    before, so no task sees all sources.
    """
    ordered = F.col("source").asc_nulls_last()
    parts = materialise(
        totals.repartitionByRange(ordered)
        .sortWithinPartitions(ordered)
        .select("*", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % (1 << 33)).alias("at")),
        "mix-ranks",
    )
    # One row a partition.
    before = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        F.col("part").alias("b_part"),
        (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    ranked = parts.join(before, F.col("part") == F.col("b_part")).select(
        "source", "source_size", "n_docs", (F.col("at") + F.col("before")).alias("rank")
    )
    return hand_over(parts, ranked)


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``totals`` (source, source_size, n_docs) with target.

    The sources share ``share`` of all sizes by weight.  Targets stop at
    ``max_copies`` times the source's size and the excess is shared anew, until
    none is above: the level of the others rises, and each round fixes the
    sources that it takes to their limit.  A round moves three numbers.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    places = _ranked(totals)
    ranked = materialise(
        places.select(
            "source", "source_size", "n_docs",
            weight.cast("double").alias("weight"),
            (max_copies * F.col("source_size")).cast("double").alias("most"),
        ),
        "mix-sources",
    )
    discard(places)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, n_full = 0.0, -1
    while True:
        full = F.col("most") <= level * F.col("weight")
        n, fixed, weight_left = ranked.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == n_full or not weight_left:
            break
        n_full, level = n, (share * total - fixed) / weight_left
    targets = ranked.select(
        "source", "source_size", "n_docs", F.least("most", F.lit(level) * F.col("weight")).alias("target")
    )
    return hand_over(ranked, targets)


def _uniform(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(1 << 53)


def _pair(state: Column, x: Column, level: int) -> Column:
    """One meeting of the open fraction of a block with the next document."""
    cur, done = state["cur"], state["done"]

    def item(of: Column, p: Column) -> Column:
        return F.struct(of["doc_id"], of["row_hash"], of["size"], of["h"], p.alias("p")).cast(f"struct<{_typed(_ITEM)}>")

    def closed(of: Column, copies: int) -> Column:
        return F.struct(of["doc_id"], of["row_hash"], of["size"], F.lit(copies).alias("copies")).cast(
            f"struct<{_typed(_DONE)}>"
        )

    def step(keep: Column, leave: Column, copies: int) -> Column:
        return F.struct(keep.alias("cur"), F.concat(done, F.array(closed(leave, copies))).alias("done"))

    s1, s2, p1, p2 = cur["size"], x["size"], cur["p"], x["p"]
    up1, down1, up2, down2 = (1 - p1) * s1, p1 * s1, (1 - p2) * s2, p2 * s2
    to_cur, to_x = F.least(up1, down2), F.least(down1, up2)
    u = _uniform(F.lit(SEED), F.lit(level), cur["h"], x["h"])
    return (
        F.when(cur.isNull(), F.struct(x.alias("cur"), done.alias("done")))
        .when(
            u * (to_cur + to_x) < to_x,
            F.when(up1 <= down2, step(item(x, p2 - up1 / s2), cur, 1)).otherwise(step(item(cur, p1 + down2 / s1), x, 0)),
        )
        .otherwise(
            F.when(down1 <= up2, step(item(x, p2 + down1 / s2), cur, 0)).otherwise(step(item(cur, p1 - up2 / s1), x, 1))
        )
    )


def _meeting(level: int):
    return lambda state, x: _pair(state, x["item"], level)


def _typed(fields: str) -> str:
    return ", ".join(":".join(f.split()) for f in fields.split(","))


def _round(items: DataFrame, most_docs: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(source, doc) rows with rounded copies, level by level.

    items: source, n_docs and item.  Returns the closed documents of all levels.
    """
    closed = None
    level, width = 0, block
    while True:
        n_blocks = F.ceil(F.col("n_docs") / F.lit(width))
        blocked = items.withColumn("block", F.pmod(F.xxhash64("item.h", F.lit(level)), n_blocks))
        start = F.expr(f"named_struct('cur', CAST(NULL AS struct<{_typed(_ITEM)}>), 'done', CAST(array() AS array<struct<{_typed(_DONE)}>>))")
        folded = (
            blocked.groupBy("source", "n_docs", "block")
            .agg(F.array_sort(F.collect_list(F.struct("item.h", "item"))).alias("met"))
            .select(
                "source",
                "n_docs",
                F.aggregate("met", start, _meeting(level)).alias("left"),
            )
            .select("source", "n_docs", "left.cur", "left.done")
        )
        folded = materialise(folded, f"mix-level{level}")
        rounded = folded.select("source", F.inline("done"))
        closed = rounded if closed is None else closed.unionByName(rounded)
        items = folded.select("source", "n_docs", F.col("cur").alias("item"))
        if width >= most_docs:
            last = items.select(
                "source", "item.doc_id", "item.row_hash", "item.size", F.round("item.p").cast("int").alias("copies")
            )
            return closed.unionByName(last)
        level, width = level + 1, width * block


def _numbered(sized: DataFrame) -> DataFrame:
    """A row for each of ``rows``, numbered (nth), so that rows that repeat one id
    and text meet in different blocks.  No task makes more than REPEATS of one."""
    many = sized.where(F.col("rows") > 1)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("rows") - 1).cast("long"), F.lit(REPEATS).cast("long"))).alias("low")
    last = F.least(F.col("low") + REPEATS, F.col("rows")) - 1
    each = spread(many.select("*", chunk)).withColumn("nth", F.explode(F.sequence(F.col("low"), last))).drop("low", "rows")
    return sized.where(F.col("rows") == 1).withColumn("nth", F.lit(0).cast("long")).drop("rows").unionByName(each)


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: source, doc_id, row_hash, size, source_size,
    target and copies, the times that the mix takes the document.

    Size is the number of words; null text counts as empty, and empty texts
    are never taken.  A null source is a source of its own, the last.  Random
    choices depend on the seed and the rows alone, so reruns agree; of rows
    that repeat one id and text, each has its own copies.  The last fraction of
    a source goes to the nearer whole number.  Other columns are ignored.
    """
    # Rows that repeat one id and text are one row with their number here.
    sized = materialise(
        docs.select(
            F.col("source").cast("string").alias("source"),
            F.col("doc_id").cast("long").alias("doc_id"),
            text_hash(text_column()).alias("row_hash"),
            F.regexp_count(text_column(), F.lit(WORD)).cast("long").alias("size"),
        )
        .groupBy("source", "doc_id", "row_hash", "size")
        .agg(F.count("*").alias("rows")),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n_docs"))
    found = source_targets(totals, weights, share, max_copies)
    targets = materialise(found, "mix-targets")
    discard(found)
    n_sources, most_docs = targets.agg(F.count("*"), F.coalesce(F.max("n_docs"), F.lit(0))).first()
    small = F.broadcast(targets) if n_sources <= BROADCAST_SOURCES else targets
    small = small.select(
        F.col("source").alias("t_source"), "source_size", "n_docs", "target",
        F.coalesce(F.col("target") / F.col("source_size"), F.lit(0.0)).alias("expected"),
    )
    joined = _numbered(sized).join(small, F.col("source").eqNullSafe(F.col("t_source"))).withColumn(
        "part", F.when(F.col("size") > 0, F.col("expected") - F.floor("expected")).otherwise(0.0)
    )
    item = F.struct(
        "doc_id",
        "row_hash",
        "size",
        F.xxhash64("doc_id", "row_hash", "nth", F.lit(SEED)).alias("h"),
        F.col("part").alias("p"),
    )
    rounded = _round(joined.where(F.col("part") > 0).select("source", "n_docs", item.alias("item")), most_docs, block)
    whole = joined.where(F.col("part") == 0).select("source", "doc_id", "row_hash", "size", F.lit(0).alias("copies"))
    return (
        rounded.unionByName(whole)
        .join(small, F.col("source").eqNullSafe(F.col("t_source")))
        .select(
            "source", "doc_id", "row_hash", "size", "source_size", "target",
            F.when(F.col("size") > 0, F.col("copies") + F.floor("expected")).otherwise(0).cast("long").alias("copies"),
        )
    )
