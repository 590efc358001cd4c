"""Merkle manifest of a dataset: trees of digests by group, under one root.

Built from the bottom: a level is the table of the runs of eight nodes of the
level below, each with its children, and is written.  Proofs are pushed down
from the top: a level joins the proofs that its nodes have inherited, and every
child puts its own siblings before them.  Groups (languages) have trees of
their own, whose tops are the leaves of the tree that ends in the root.

Digests are SHA-256 of the hexadecimal text of what they cover; tables hold
them as 32 bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import discard, materialise
from finloom.llm.numbering import numbered

#: Nodes of a run.
FAN = 8
#: The columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NO_PATH = "CAST(array() AS array<struct<left:binary,right:binary>>)"


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proof_text(path: Column) -> Column:
    """The siblings of a path as hexadecimal text, from the leaf to the root."""
    return shown(F.aggregate(path, F.lit("").cast("binary"), lambda a, p: F.concat(a, p.left, p.right)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path make."""
    start = F.unhex(shown(leaf))
    return F.aggregate(path, start, lambda h, p: F.unhex(F.sha2(shown(F.concat(p.left, h, p.right)), 256)))


@dataclass
class Tree:
    """Written levels of the trees of all groups.

    ``leaves``: group, position, n (leaves of the group), digest, item.  A table
    of ``levels``: group, position, n, children (position, digest and, on the
    lowest level, item; in order), digest.
    """

    leaves: DataFrame
    levels: list[DataFrame]

    def tops(self, level: int) -> DataFrame:
        """Nodes of a level (0: leaves) that are the tops of their groups."""
        table = self.leaves if level == 0 else self.levels[level - 1]
        return table.where(F.col("n") <= FAN**level)


def _build(leaves: DataFrame, label: str) -> Tree:
    levels: list[DataFrame] = []
    most = leaves.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    below = leaves
    while FAN ** len(levels) < most:
        child = F.struct(*(c for c in ("position", "digest", "item") if c in below.columns))
        runs = (
            below.where(F.col("n") > FAN ** len(levels))
            .groupBy("group", F.expr(f"position div {FAN}").alias("position"), "n")
            .agg(F.sort_array(F.collect_list(child)).alias("children"))
        )
        of_children = F.array_join(F.transform("children", lambda c: shown(c.digest)), "")
        below = materialise(runs.withColumn("digest", F.unhex(F.sha2(of_children, 256))), f"{label}-{len(levels) + 1}")
        levels.append(below)
    return Tree(leaves, levels)


def _push(tree: Tree, above: DataFrame) -> DataFrame:
    """group, item, digest, path, subroot of every leaf.

    ``above``: group, path of the top of every group, which is its subroot, and
    columns that all leaves of the group get.
    """
    given = [c for c in above.columns if c not in ("group", "path")]

    def tops(level: int) -> DataFrame:
        top = tree.tops(level).alias("t").join(above.alias("a"), F.col("t.group").eqNullSafe(F.col("a.group")))
        own = ["t.item", "t.digest"] if level == 0 else []
        return top.select("t.group", "t.position", *own, F.col("t.digest").alias("subroot"), "a.path", *given)

    inherited = None
    for number in range(len(tree.levels), 0, -1):
        inherited = tops(number) if inherited is None else inherited.unionByName(tops(number))
        level = tree.levels[number - 1].select("group", "position", "children").alias("l")
        same = F.col("l.group").eqNullSafe(F.col("i.group")) & (F.col("l.position") == F.col("i.position"))
        each = level.join(inherited.alias("i"), same).select("l.group", "children", "subroot", "path", *given, F.posexplode("children").alias("at", "child"))
        joined = "aggregate({}, CAST('' AS binary), (a, c) -> concat(a, c.digest))"
        step = F.struct(
            F.expr(joined.format("slice(children, 1, at)")).alias("left"),
            F.expr(joined.format(f"slice(children, at + 2, {FAN})")).alias("right"),
        )
        own = ["child.item", "child.digest"] if number == 1 else []
        inherited = each.select("group", "child.position", *own, "subroot", F.concat(F.array(step), F.col("path")).alias("path"), *given)
    return tops(0) if inherited is None else inherited.unionByName(tops(0))


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root (digests of 32 bytes),
    path (array of left and right: the digests of the siblings before and after,
    concatenated, from the leaf's run to the root's) and the columns ``carried``.

    Leaves of a group ascend by ``order`` (null first); rows that tie there by
    their digest, and equal rows are leaves of their own in any order, which
    makes no difference.  Groups ascend by the bytes of their text, null first.
    A run of one node has no siblings but is hashed; a group of one leaf has no
    runs.  No rows, no root.  Other columns of ``docs`` are ignored.
    """
    carried = carried or {}
    item = F.struct(F.col(order).cast("long").alias("doc_id"), *(c.alias(n) for n, c in carried.items()))
    leaves = docs.select(
        F.col(group).cast("string").alias("group"),
        item.alias("item"),
        leaf_digest(*(F.col(f) for f in fields)).alias("digest"),
        F.spark_partition_id().alias("dealt"),
    )
    # Texts are read once; what sorts by ranges (and samples) is this table.
    table = materialise(leaves, "merkle-digests")
    # Equal rows, however many, spread over ranges by the part they were read from.
    order_of = [F.col("item.doc_id").asc_nulls_first(), F.col("digest"), F.col("dealt")]
    tree = _build(numbered(table, ["group"], order_of, "merkle-leaves").drop("dealt"), "merkle-level")
    subroots = tree.tops(0).select("group", "digest")
    for number in range(1, len(tree.levels) + 1):
        subroots = subroots.unionByName(tree.tops(number).select("group", "digest"))
    one = F.lit(None).cast("string")
    named = subroots.select(one.alias("group"), F.struct(F.col("group").alias("name")).alias("item"), "digest")
    upper = _build(numbered(named, [], [F.col("item.name").asc_nulls_first()], "merkle-subroots"), "merkle-root")
    top = upper.tops(len(upper.levels)).select("group", "digest")
    paths = _push(upper, top.select("group", F.expr(_NO_PATH).alias("path")))
    above = materialise(paths.select(F.col("item.name").alias("group"), "path", F.col("subroot").alias("root")), "merkle-tops")
    discard(table)
    return _push(tree, above).select("item.doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", *(f"item.{n}" for n in carried))
