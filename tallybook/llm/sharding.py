"""Sharding by a two-pass external shuffle.

Pass one scatters records by seeded hashes into buckets that fit into memory. Pass two takes one bucket
at a time, puts it into a random order by Fisher-Yates, and writes it behind the buckets before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import cut, free_name, new_path

BUCKET_BYTES = 16 << 20
BUCKET_ROWS = 2048
#: A bucket of more than so many times these has rows that repeat.
CROWDED = 4
ROW_BYTES = 16
SEED = 20240607


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the highest seeded hash of (key, shard): one more shard takes rows only into itself."""
    scores = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.struct(F.xxhash64(key, s, F.lit(seed)).alias("score"), s.alias("shard")),
    )
    return F.array_max(scores)["shard"]


def fisher_yates(n: Column, *seed: Column) -> Column:
    """A permutation of 0 to n-1: entry i goes to a drawn place up to i, and what stood there to the end."""

    def step(done: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*seed, i), i + 1).cast("int")
        return F.when(j == i, F.concat(done, F.array(i))).otherwise(
            F.concat(
                F.slice(done, F.lit(1), j),
                F.array(i),
                F.slice(done, j + 2, i - j - 1),
                F.array(F.get(done, j)),
            )
        )

    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.array().cast("array<int>"), step)


def scatter(keyed: DataFrame, shards: int, bucket_bytes: int, bucket_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """``keyed`` with the bucket of each record, as many in a shard as it needs; what each bucket holds; partitions.

    ``_part`` numbers partitions of about two buckets, in the order of shards and buckets. Two numbers per shard
    reach the driver.
    """
    held = keyed.groupBy("_shard").agg(F.sum("_size").alias("bytes"), F.count("*").alias("rows")).collect()
    buckets = [1] * shards
    for r in held:
        buckets[r["_shard"]] = max(1, math.ceil(r["bytes"] / bucket_bytes), math.ceil(r["rows"] / bucket_rows))
    partitions = max(1, math.ceil(sum(r["bytes"] for r in held) / (2 * bucket_bytes)))
    own = F.get(F.array(*map(F.lit, buckets)), F.col("_shard"))
    first = F.get(F.array(*(F.lit(sum(buckets[:k])) for k in range(shards))), F.col("_shard"))
    part = F.floor((first + F.col("_bucket")) * F.lit(partitions) / F.lit(sum(buckets))).cast("int")
    placed = keyed.withColumn("_bucket", F.pmod("_scatter", own).cast("int")).withColumn("_part", part)
    counts = placed.groupBy("_part", "_shard", "_bucket").agg(
        F.count("*").alias("_rows"), F.sum("_size").alias("_bytes"), F.max("_size").alias("_longest")
    )
    return placed, cut(counts, "bucket-counts"), partitions


def shard_columns(names: Iterable[str]) -> tuple[str, str, str]:
    """The columns that ``shard`` adds, for size, shard and slot: with ``_`` behind where a name is taken."""
    names = list(names)
    return tuple(free_name(names, c) for c in ("_size", "_shard", "_slot"))


def shard(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with ``_size``, ``_shard`` and ``_slot``, in a seeded random order within each shard.

    The id and the number of shards decide the shard. A record's size is its text's UTF-8 bytes plus 16;
    a null text has none. Slots count from 0 without gaps. Each shard's records are scattered over as many
    buckets as keep one near ``bucket_bytes`` and ``bucket_rows``, by a hash of id and text, so the shard of
    a hot id has more of them. Where rows equal in id and text would crowd a bucket, all rows are numbered
    and written once, and scattered by that number too. Rows that tie in the scatter order are alike in id
    and text and may swap. A null id is a key like any other; an empty table gives an empty result. Other
    columns are carried along under their own names; where they take one of the new ones, the new column has
    ``_`` behind (``shard_columns``). Partitions hold buckets in the order of shards and slots.
    """
    size_col, shard_col, slot_col = shard_columns(docs.columns)
    size = (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + ROW_BYTES).cast("bigint")
    keyed = docs.select(
        F.struct("*").alias("_record"),
        size.alias("_size"),
        F.col(id_col).alias("_id"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_scatter"),
    )
    keyed = keyed.withColumn("_shard", shard_of(F.col("_id"), shards, seed))
    placed, counts, partitions = scatter(keyed, shards, bucket_bytes, bucket_rows)
    crowded = (F.col("_rows") > CROWDED * bucket_rows) | (F.col("_bytes") > CROWDED * bucket_bytes + F.col("_longest"))
    if not counts.where(crowded).isEmpty():
        number = F.xxhash64("_scatter", F.monotonically_increasing_id())
        numbered = cut(keyed.withColumn("_scatter", number), "numbered-records")
        placed, counts, partitions = scatter(numbered, shards, bucket_bytes, bucket_rows)
    before = counts.select(
        "_part",
        "_shard",
        "_bucket",
        F.lit(None).cast(placed.select(F.struct("_scatter", "_size", "_record")).schema[0].dataType).alias("_entry"),
        F.col("_rows").cast("int").alias("_rows"),
        F.expr(
            "coalesce(sum(_rows) over (partition by _shard order by _bucket"
            " rows between unbounded preceding and 1 preceding), 0)"
        ).alias("_before"),
    )
    # What is known of a bucket travels as one more entry of it, so nothing is joined after the shuffle.
    entries = placed.select(
        "_part",
        "_shard",
        "_bucket",
        F.struct("_scatter", "_size", "_record").alias("_entry"),
        F.lit(None).cast("int").alias("_rows"),
        F.lit(None).cast("bigint").alias("_before"),
    )
    dealt = entries.unionByName(before).repartitionById(partitions, F.col("_part"))
    # Only that entry draws, once it is there; records are sorted behind it, never held as one array.
    drawn = dealt.withColumn(
        "_order", F.when(F.col("_rows").isNotNull(), fisher_yates(F.col("_rows"), F.lit(seed), F.col("_shard"), F.col("_bucket")))
    )
    # The order of arrival differs from run to run; the shuffle starts from the scatter hash's order.
    bucket = Window.partitionBy("_part", "_shard", "_bucket").orderBy(F.col("_entry").isNotNull(), "_entry._scatter")
    bucket = bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = drawn.select(
        "_shard",
        F.col("_entry").alias("_r"),
        (F.row_number().over(bucket) - 2).alias("_start"),
        F.first("_before").over(bucket).alias("_before"),
        F.first("_order").over(bucket).alias("_order"),
    ).where("_r is not null")
    at = F.array_position("_order", F.col("_start")) - 1
    names = [F.col(f"_r._record.`{c.replace('`', '``')}`") for c in docs.columns]
    return out.select(
        *names,
        F.col("_r._size").alias(size_col),
        F.col("_shard").alias(shard_col),
        (F.col("_before") + at).cast("bigint").alias(slot_col),
    )


def write_shards(sharded: DataFrame, path: str | None = None, shard_col: str = "_shard", slot_col: str = "_slot") -> DataFrame:
    """Write one folder per shard and read it back. A shard's files in the order of their names hold its slots in order."""
    spark = sharded.sparkSession
    path = path or new_path(spark, "shards")
    sharded.sortWithinPartitions(shard_col, slot_col).write.partitionBy(shard_col).parquet(path)
    # Reading with the schema also serves an empty table, which leaves no shard folder to infer from.
    return spark.read.schema(sharded.schema).parquet(path)
