"""Merkle manifest of a dataset by lag and lead windows.

Each row is a leaf, each group of rows a tree, and the groups' roots are the leaves of one more tree. Runs
of ``FANOUT`` neighbours become their parent. Rows stay where they are while the tree grows: at a level, the
row of a node's first leaf stands for the node, and its siblings are that many rows before and behind. So
lag and lead with one fixed offset, masked by the slot in the run and the length of the run, supply the
siblings, and rows of first children hash the parents.

A window holds a block of ``FANOUT ** LEVELS`` neighbours, which no run crosses; the roots of blocks are the
rows of the next round. So no task holds a whole group, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import cut

FANOUT = 3
#: Levels that a window builds: its blocks hold 3 ** 7 = 2,187 rows.
LEVELS = 7
STEP = "struct<left:string,right:string>"


def encoded(*columns: Column) -> Column:
    """The values one after the other: ``-`` if null, else number of UTF-8 bytes, ``:`` and the value as text."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["left"], own, step["right"]))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings of a path, from the leaf upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, the place in their ``key`` from 0, and ``total``, the rows of the key.

    Rows are sorted over all tasks by key and ``order`` and counted per task and key; these counts are summed up.
    A hot key is spread over many tasks. Rows equal in ``order`` may swap.
    """
    lone = cut(
        rows.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange("key", *order, "_spread")
        .sortWithinPartitions("key", *order, "_spread")
        .drop("_spread")
        .withColumn("_row", F.monotonically_increasing_id()),
        "merkle-order",
    ).withColumn("_task", F.shiftright("_row", 33))
    runs = lone.groupBy("key", "_task").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    by_key = Window.partitionBy("key").orderBy("_task")
    runs = runs.select(
        "key",
        "_task",
        (F.sum("_rows").over(by_key) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("key")).alias("total"),
    )
    return lone.join(runs, ["key", "_task"]).withColumn("at", F.col("_row") + F.col("_shift")).drop(
        "_row", "_task", "_shift"
    )


def climbed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (key, at, total, d) with ``block``, ``path`` (steps inside of the block) and ``top``.

    ``top`` is the block's root, in the row of its first node.
    """
    spec = Window.partitionBy("key", "block").orderBy("at")
    so_far = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = [c for c in nodes.columns if c != "d"]
    rows = nodes.withColumn("block", F.floor(F.col("at") / fanout**levels)).withColumnRenamed("d", "d0")
    empty = F.lit("")
    for level in range(levels):
        width = fanout**level
        own = F.col(f"d{level}")
        first = F.col("at") % width == 0
        unfinished = F.col("total") > width  # more than one node is left at this level
        slot = F.floor(F.col("at") / width) % fanout
        # Beyond the end of the last run there is no row, which makes lead null.
        left = [F.when(slot >= k, F.lag(own, k * width).over(spec)) for k in range(fanout - 1, 0, -1)]
        right = [F.when(slot < fanout - k, F.lead(own, k * width).over(spec)) for k in range(1, fanout)]
        step = F.struct(
            F.concat(*(F.coalesce(x, empty) for x in left)).alias("left"),
            F.concat(*(F.coalesce(x, empty) for x in right)).alias("right"),
        )
        rows = rows.withColumn(f"s{level}", F.when(first & unfinished, step))
        parent = F.when(unfinished, digest(own, F.col(f"s{level}.right"))).otherwise(own)
        rows = rows.withColumn(f"d{level + 1}", F.when(F.col("at") % (width * fanout) == 0, parent))
    # Every row gets the step of the node above it, which stands in the last row that has one.
    steps = [F.last(f"s{level}", ignorenulls=True).over(so_far).alias(f"s{level}") for level in range(levels)]
    rows = rows.select(*carried, "block", F.col("d0").alias("d"), F.col(f"d{levels}").alias("top"), *steps)
    path = F.filter(F.array(*(F.col(f"s{level}") for level in range(levels))), lambda s: s.isNotNull())
    return rows.select(*carried, "block", "d", "top", path.alias("path"))


def _grown(
    nodes: DataFrame, finish: Callable[[DataFrame], DataFrame], fanout: int, levels: int
) -> DataFrame:
    """(key, at, carried columns, d) of ``nodes`` with ``path`` up to the end and what ``finish`` adds to a root."""
    if (nodes.agg(F.max("total")).first()[0] or 0) <= 1:
        return finish(nodes)
    rows = cut(climbed(nodes, fanout, levels), "merkle-nodes")
    size = fanout**levels
    tops = rows.where(F.col("at") % size == 0).select(
        "key", F.col("block").alias("at"), F.ceil(F.col("total") / size).alias("total"), F.col("top").alias("d")
    )
    above = _grown(tops, finish, fanout, levels).drop("total", "d")
    above = above.withColumnRenamed("at", "block").withColumnRenamed("path", "_above")
    return rows.join(above, ["key", "block"]).withColumn("path", F.concat("path", "_above")).drop(
        "_above", "block", "top"
    )


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str],
    id_col: str = "doc_id",
    group_col: str = "source",
    also: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``group``, ``leaf``, ``at``, ``total``, ``subroot``, ``path``, ``root``.

    A leaf is the SHA-256 of the encoded ``columns``. In a group, leaves stand by id, a null id first, rows
    that share an id by leaf; rows alike in all of it are interchangeable. Groups stand by their bytes, a null
    group first. ``path`` lists the siblings left and right of the way from the leaf over the ``subroot`` of
    the group to the ``root`` of the table; a run of one has a step without siblings, as it is hashed too.
    ``also`` adds columns of ``docs`` under names of their own; all others are left out, so no name can
    clash. Nulls are values of their own (``-``), unlike empty texts. An empty table gives an empty result.
    """
    also = dict(also or {})
    leaves = cut(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("key"),
            F.struct(
                F.col(id_col).alias("id"),
                F.col(group_col).alias("group"),
                *(c.alias(name) for name, c in also.items()),
            ).alias("row"),
            digest(encoded(*(F.col(c) for c in columns))).alias("d"),
        ),
        "merkle-leaves",
    ).withColumn("id", F.col("row.id"))

    def whole(roots: DataFrame) -> DataFrame:
        return roots.withColumn("path", F.expr(f"cast(array() as array<{STEP}>)")).withColumn("root", F.col("d"))

    def groups(roots: DataFrame) -> DataFrame:
        named = cut(roots.select("key", "d"), "merkle-groups")
        one_tree = placed(named.select(F.lit("").alias("key"), F.col("key").alias("name"), "d"), "name")
        tops = _grown(one_tree, whole, fanout, levels)
        return roots.join(
            tops.select(F.col("name").alias("key"), "path", "root", F.col("d").alias("subroot")), "key"
        )

    trees = _grown(placed(leaves, "id", "d").drop("id"), groups, fanout, levels)
    return trees.select("row.*", F.col("d").alias("leaf"), "at", "total", "subroot", "path", "root")


def verified(manifest: DataFrame, leaf: Column) -> DataFrame:
    """``manifest`` with ``folded_root``, recomputed from ``leaf`` and the siblings, and whether it is the root."""
    folded = manifest.withColumn("folded_root", fold(leaf, F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def group_roots(manifest: DataFrame) -> DataFrame:
    """``group``, number of ``rows`` and ``subroot`` of each group: what two versions of a table compare first."""
    return manifest.groupBy("group").agg(F.count("*").alias("rows"), F.first("subroot").alias("subroot"))


def changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """(group, id, leaf, copies) that stand in one manifest more often than in the other; ``copies`` > 0: in the new one.

    Groups with equal roots are left out before any leaf is compared.
    """
    roots = group_roots(old).withColumn("side", F.lit(0)).unionByName(group_roots(new).withColumn("side", F.lit(1)))
    moved = roots.groupBy("group").agg(
        F.min("subroot").alias("a"), F.max("subroot").alias("b"), F.count("*").alias("sides")
    ).where("a <> b or sides = 1").select(F.col("group").alias("moved"))
    rows = old.select("group", "id", "leaf", F.lit(-1).alias("n")).unionByName(
        new.select("group", "id", "leaf", F.lit(1).alias("n"))
    )
    own = rows.join(moved, F.col("group").eqNullSafe(F.col("moved")), "left_semi")
    return own.groupBy("group", "id", "leaf").agg(F.sum("n").alias("copies")).where("copies <> 0")
