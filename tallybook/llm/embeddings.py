"""Near-duplicate vectors by int8 tile products with error bounds.

A unit vector x is rounded to x' = scale * q with integers q up to 127. Its error is the length of x - x',
computed exactly. For two vectors the cosine differs from x'.y' by at most e_x + |x'| e_y. Tiles of blocks
get the integers, one byte a component, and what follows from the bound is final: pairs that must link
and pairs that cannot. Only vectors with a pair in between go to their tile again, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import connected, cut

#: Vectors of a block. A tile compares two blocks, and holds a byte a pair in memory.
BLOCK = 4096
#: Bytes of a strip of a tile that are computed together.
STRIP = 32 << 20
#: How far rounding in floats may move a comparison; pairs nearer to a bound are computed in double.
MARGIN = 1e-9


@dataclass
class Quantised:
    """Integers, and per vector the scale, the length of the rounded vector and the error."""

    q: np.ndarray
    scale: np.ndarray
    length: np.ndarray
    error: np.ndarray

    def __len__(self) -> int:
        return len(self.q)

    def __getitem__(self, at) -> Quantised:
        return Quantised(self.q[at], self.scale[at], self.length[at], self.error[at])


def quantise(x: np.ndarray) -> Quantised:
    """The rounded unit vectors; components beyond the range of doubles are scaled down first."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    rounded = q * scale[:, None]
    return Quantised(q.astype(np.int8), scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(unit - rounded, axis=1))


def tile_masks(x: Quantised, y: Quantised, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs link for certain, and which the bound leaves open; of one block with itself, each pair once.

    One product in float32 and one comparison leave out what lies below the widest bound of the tile; only rows and
    columns with a pair beyond it are compared by their own bounds.
    """
    linked, open_ = np.zeros((len(x), len(y)), bool), np.zeros((len(x), len(y)), bool)
    if not len(x) or not len(y):
        return linked, open_
    dimensions = x.q.shape[1]
    # Rounding of scaled components, products and sums in float32, for rounded vectors of a length up to 1 + error.
    slack = (dimensions + 8) * 2.0**-22 * float(x.length.max() * y.length.max())
    least = np.float32(threshold - MARGIN - slack - float(x.error.max() + x.length.max() * y.error.max()))
    right = (y.q * y.scale[:, None]).astype(np.float32).T
    step = max(1, STRIP // (8 * len(y)))
    for a in range(0, len(x), step):
        own = x[a : a + step]
        near = (own.q * own.scale[:, None]).astype(np.float32) @ right >= np.nextafter(least, np.float32(-np.inf))
        if same:
            near &= np.arange(len(y))[None, :] > np.arange(a, a + len(own))[:, None]
        rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if len(rows):
            above, unsure = _by_bound(own[rows], y[columns], threshold)
            near = near[np.ix_(rows, columns)]
            at = np.ix_(a + rows, columns)
            linked[at], open_[at] = above & near, unsure & near
    return linked, open_


def _by_bound(x: Quantised, y: Quantised, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    # Integer sums up to 127 * 127 * dimensions are exact in float32 up to 1040 dimensions, in double beyond.
    kind = np.float32 if 127 * 127 * x.q.shape[1] < 1 << 24 else np.float64
    # The cosine lies within the bound of product * scale * scale; all is divided by the scales.
    product = x.q.astype(kind) @ y.q.T.astype(kind)
    bound = x.error[:, None] + x.length[:, None] * y.error[None, :]
    scales = x.scale[:, None] * y.scale[None, :]
    above = product >= (threshold + MARGIN + bound) / scales
    return above, ~above & (product >= (threshold - MARGIN - bound) / scales)


def exact_links(x: np.ndarray, y: np.ndarray, open_: np.ndarray, threshold: float) -> np.ndarray:
    """Of the open pairs, those whose cosine in double precision reaches the threshold."""
    out = np.zeros_like(open_)
    length_x, length_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    step = max(1, STRIP // (8 * max(1, x.shape[1])))
    i, j = np.nonzero(open_)
    for a in range(0, len(i), step):
        p, r = i[a : a + step], j[a : a + step]
        out[p, r] = np.einsum("ij,ij->i", x[p], y[r]) / (length_x[p] * length_y[r]) >= threshold
    return out


def smallest_labels(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest label that each row and each column of a tile can reach."""
    rows, columns = linked.any(axis=1), linked.any(axis=0)
    mask, least_x, least_y = linked[np.ix_(rows, columns)], x[rows].copy(), y[columns].copy()
    top = np.iinfo(np.int64).max
    step = max(1, STRIP // (8 * max(1, len(least_y))))
    moved = mask.size > 0
    while moved:
        before = least_x.copy(), least_y.copy()
        for a in range(0, len(mask), step):
            own = mask[a : a + step]
            np.minimum(least_x[a : a + step], np.where(own, least_y[None, :], top).min(axis=1), out=least_x[a : a + step])
            np.minimum(least_y, np.where(own, least_x[a : a + step, None], top).min(axis=0), out=least_y)
        moved = (before[0] != least_x).any() or (before[1] != least_y).any()
    out_x, out_y = x.copy(), y.copy()
    out_x[rows], out_y[columns] = least_x, least_y
    return out_x, out_y


@dataclass
class _Tile:
    """The two sides of a tile; of one block with itself, both are the same."""

    table: pa.Table
    x: np.ndarray
    y: np.ndarray
    same: bool

    @classmethod
    def of(cls, table: pa.Table) -> _Tile:
        order = np.lexsort([table.column("no").to_numpy(), table.column("block").to_numpy()])
        table = table.take(pa.array(order))
        block = table.column("block").to_numpy()
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        middle = len(block) if same else int(np.searchsorted(block, block[-1]))
        at = np.arange(len(block))
        return cls(table, at if same else at[:middle], at if same else at[middle:], same)

    def quantised(self) -> Quantised:
        q = np.frombuffer(b"".join(self.table.column("q").to_pylist()), np.int8).reshape(len(self.table), -1)
        return Quantised(q, *(self.table.column(c).to_numpy() for c in ("scale", "length", "error")))

    def sums(self, linked: np.ndarray, open_: np.ndarray | None) -> pa.Table:
        """Per vector: the weight of its links, a tie to a vector it is connected with, and whether pairs are open."""
        n = len(self.table)
        cls, weight = self.table.column("cls").to_numpy(), self.table.column("weight").to_numpy()
        links, unsure = np.zeros(n, np.int64), np.zeros(n, bool)
        # Only rows and columns with links, as products turn all of a mask into doubles.
        rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        own = linked[np.ix_(rows, columns)]
        links[self.x[rows]] += (own @ weight[self.y[columns]].astype(float)).astype(np.int64)
        links[self.y[columns]] += (weight[self.x[rows]].astype(float) @ own).astype(np.int64)
        if open_ is not None:
            unsure[self.x] |= open_.any(axis=1)
            unsure[self.y] |= open_.any(axis=0)
        tie = cls.copy()
        both = linked | linked.T if self.same else linked
        tie[self.x], least_y = smallest_labels(both, cls[self.x], cls[self.y])
        if not self.same:
            tie[self.y] = least_y
        hit = np.flatnonzero((links > 0) | unsure)
        own = self.table.select(["bytes", "i", "j", "no", "cls"]).take(pa.array(hit))
        return own.append_column("links", pa.array(links[hit])).append_column("tie", pa.array(tie[hit])).append_column(
            "unsure", pa.array(unsure[hit])
        )


SUMS = "bytes int, i int, j int, no long, cls long, links long, tie long, unsure boolean"


def _bounded(table: pa.Table, threshold: float) -> pa.Table:
    """Of one tile, what the bound decides."""
    tile = _Tile.of(table)
    all_ = tile.quantised()
    linked, open_ = tile_masks(all_[tile.x], all_[tile.y], threshold, tile.same)
    return tile.sums(linked, open_)


def _resolved(table: pa.Table, threshold: float) -> pa.Table:
    """Of the vectors of one tile that the bound left unsure, the open pairs that do link."""
    tile = _Tile.of(table)
    all_ = tile.quantised()
    _, open_ = tile_masks(all_[tile.x], all_[tile.y], threshold, tile.same)
    exact = np.frombuffer(b"".join(tile.table.column("vector").to_pylist()), np.float64).reshape(len(tile.table), -1)
    return tile.sums(exact_links(exact[tile.x], exact[tile.y], open_, threshold), None)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; null where one cannot link."""
    for batch in batches:
        lists = batch.column(1)
        flat, offsets = lists.values.to_numpy(zero_copy_only=False).astype(np.float64), lists.offsets.to_numpy()
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])  # nulls have become not-a-number
        full = np.concatenate([[0], np.cumsum(flat != 0)])
        start, end = offsets[:-1], offsets[1:]
        usable = (bad[end] == bad[start]) & (full[end] > full[start]) & lists.is_valid().to_numpy(zero_copy_only=False)
        data = [flat[a:b].tobytes() if ok else None for a, b, ok in zip(start, end, usable.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["id", "vector"])


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = batch.column(0).to_pylist()
        sizes = np.array([len(v) for v in data])
        q: list = [None] * len(data)
        scale, length, error = (np.zeros(len(data)) for _ in range(3))
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            own = quantise(np.frombuffer(b"".join(data[i] for i in at), np.float64).reshape(len(at), -1))
            scale[at], length[at], error[at] = own.scale, own.length, own.error
            for i, row in zip(at.tolist(), own.q, strict=True):
                q[i] = row.tobytes()
        columns = [*batch.columns, pa.array(q, pa.binary()), pa.array(scale), pa.array(length), pa.array(error)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "q", "scale", "length", "error"])


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id``, ``kept``.

    Two vectors link when their cosine in double precision reaches the threshold. Vectors that are null, all
    zero, empty, or hold a null or a value that is not finite link with nothing; nor do vectors of different
    lengths with each other. Rows without an id link with nothing and are kept. Rows that repeat an
    id with different vectors share the links of them all. ``component_id`` is the smallest id reachable by links, itself
    included. Other columns are left out; an empty table gives an empty result.

    Equal vectors are one row with a weight. The rest is dealt into blocks by a hash, and each pair of blocks
    is one task's tile: all pairs are compared, none is emitted. A tile gets a byte a component, and returns sums
    and ties per vector; the vectors of its open pairs meet once more as doubles.
    """
    rows = cut(
        vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .mapInArrow(_packed, "id long, vector binary"),
        "vectors",
    )
    known = rows.where("vector is not null and id is not null")
    grouped = known.groupBy("vector").agg(F.min("id").alias("first"), F.count("*").alias("weight"))
    classes = cut(
        grouped.select("vector", "first", "weight", F.xxhash64("vector", "first").alias("hash"))
        .mapInArrow(
            _quantised,
            "vector binary, first long, weight long, hash long, q binary, scale double, length double, error double",
        )
        .withColumn("no", F.monotonically_increasing_id()),
        "vector-classes",
    )
    sizes = classes.groupBy(F.octet_length("vector").alias("bytes")).count().collect()
    blocks = max(1, -(-sum(r["count"] for r in sizes) // block))
    # Vectors of one length share tiles; an id can stand for several vectors, so a class has its own number.
    light = classes.select(
        "no", F.col("first").alias("cls"), "weight", "q", "scale", "length", "error", F.octet_length("q").alias("bytes"),
        F.pmod("hash", F.lit(blocks)).cast("int").alias("block"),
    )
    each = light.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiles = each.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")
    found = cut(tiles.groupBy("bytes", "i", "j").applyInArrow(lambda t: _bounded(t, threshold), SUMS), "tile-sums")
    unsure = found.where("unsure").select("bytes", "i", "j", "no")
    again = unsure.join(light.drop("bytes"), "no").join(classes.select("no", "vector"), "no")
    more = cut(again.groupBy("bytes", "i", "j").applyInArrow(lambda t: _resolved(t, threshold), SUMS), "open-sums")
    found = found.unionByName(more)
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = connected(found.select(F.col("cls").alias("a"), F.col("tie").alias("b"))).select(
        F.col("node").alias("cls"), "component"
    )
    of_class = cut(
        classes.select("vector", F.col("first").alias("cls"), "weight").join(links, "cls", "left").join(parts, "cls", "left"),
        "linked-classes",
    )
    out = rows.join(of_class, "vector", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("id").isNull(), 0).otherwise(
            F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1
        ).cast("bigint").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "cls", "id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
