"""Conflict-constrained best-fit packing of documents into sequences of a fixed length."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 11
#: Documents that one call packs, about.
GROUP_ROWS = 4096


def best_fit(
    items: Iterable[tuple[int, int, object, object]], capacity: int, per_source: int
) -> list[tuple[int, int, int, int, int]]:
    """(item, piece start, piece size, bin, start in bin) for (item, size, source, cluster).

    Largest pieces first. Bins are ordered by what is left in them; the search starts at the first that
    holds the piece and goes on to the next until one is compatible: it has fewer than ``per_source``
    documents of the source and none of the cluster. Both are bitmaps: ``per_source`` bits per source, one
    per cluster. A document longer than a bin gives whole bins and a rest, which is packed like others.
    """
    items = list(items)
    sources = {s: i for i, s in enumerate(dict.fromkeys(x[2] for x in items))}
    twice = [c for c, n in Counter(x[3] for x in items if x[3] is not None).items() if n > 1]
    clusters = {c: 1 << i for i, c in enumerate(twice)}
    out, rests, bins = [], [], 0
    for item, size, source, cluster in items:
        for start in range(0, size - size % capacity, capacity):
            out.append((item, start, capacity, bins, 0))
            bins += 1
        if size % capacity or not size:
            rests.append((-(size % capacity), item, size - size % capacity, sources[source], clusters.get(cluster, 0)))
    rests.sort()
    order: list[tuple[int, int]] = []  # (room, bin)
    filled: dict[int, tuple[int, int]] = {}  # bin -> bitmaps of sources and clusters
    full = (1 << per_source) - 1
    for negative, item, start, source, cluster in rests:
        size, shift = -negative, source * per_source
        i = bisect_left(order, (size, -1))
        while i < len(order):
            by_source, by_cluster = filled[order[i][1]]
            if not by_cluster & cluster and by_source >> shift & full != full:
                break
            i += 1
        if i < len(order):
            room, to = order.pop(i)
        else:
            room, to, by_source, by_cluster = capacity, bins, 0, 0
            bins += 1
        taken = by_source >> shift & full
        filled[to] = by_source | (taken + 1) << shift, by_cluster | cluster
        out.append((item, start, size, to, capacity - room))
        insort(order, (room - size, to))
    return out


def _pack(table: pa.Table, capacity: int, per_source: int) -> pa.Table:
    names = ("row", "size", "source", "cluster")
    rows = sorted(zip(*(table.column(n).to_pylist() for n in names), strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    packed = best_fit([(i, r[1], r[2], r[3]) for i, r in enumerate(rows)], capacity, per_source)
    group = table.column("group")[0].as_py()
    columns = list(zip(*packed, strict=True))
    return pa.table(
        {
            "row": pa.array([rows[i][0] for i in columns[0]], pa.int64()),
            "size": pa.array([rows[i][1] for i in columns[0]], pa.int64()),
            "source": pa.array([rows[i][2] for i in columns[0]], pa.string()),
            "piece_start": pa.array(columns[1], pa.int64()),
            "piece_size": pa.array(columns[2], pa.int64()),
            "bin": pa.array([group << 32 | b for b in columns[3]], pa.int64()),
            "bin_start": pa.array(columns[4], pa.int64()),
        }
    )


def pack(
    docs: DataFrame,
    size: Column,
    cluster: Column,
    capacity: int = 2048,
    per_source: int = 4,
    id_col: str = "doc_id",
    source_col: str = "source",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: ``id_col``, ``source``, ``size``, ``piece_start``, ``piece_size``, ``bin``, ``bin_start``.

    Every document is placed whole, longer ones in pieces of ``capacity``. No bin holds two documents of one
    duplicate cluster, or more than ``per_source`` of one source. A null cluster conflicts with nothing; a
    null source is a source; sizes that are null count as 0, and an empty document stands in a bin with no
    length. Rows with equal ids are packed each. An empty table gives an empty result; other columns are
    left out. Documents are dealt by a hash into groups of about ``group_rows``, each packed alone, so no task
    grows with the table and a hot source or cluster is spread over all groups. Rows alike in id, size, source
    and cluster are counted first and dealt by number, so a row that is repeated is spread as well, and what
    a lost executor repeats is the same.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("row"),
        F.coalesce(size, F.lit(0)).cast("bigint").alias("size"),
        F.col(source_col).cast("string").alias("source"),
        cluster.cast("bigint").alias("cluster"),
    )
    groups = max(1, -(-docs.count() // group_rows))
    # Copies in two steps, so that no row grows with their number: by the thousand, then each.
    alike = rows.groupBy(rows.columns).agg(F.count("*").alias("copies"))
    thousands = alike.withColumn("thousand", F.explode(F.expr("sequence(0, (copies - 1) div 1000)")))
    last = F.least(F.col("copies"), (F.col("thousand") + 1) * 1000) - 1
    each = thousands.withColumn("copy", F.explode(F.sequence(F.col("thousand") * 1000, last)))
    key = F.xxhash64(F.lit(SEED), "row", "cluster", "size", "source", "copy")
    dealt = each.select(*rows.columns, F.pmod(key, F.lit(groups)).alias("group"))
    packed = dealt.groupBy("group").applyInArrow(
        lambda t: _pack(t, capacity, per_source),
        "row long, size long, source string, piece_start long, piece_size long, bin long, bin_start long",
    )
    return packed.withColumnRenamed("row", id_col)
