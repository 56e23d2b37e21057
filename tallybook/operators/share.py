"""Shares of a total, and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import share_pct


def with_totals(groups: DataFrame, **totals: Column) -> DataFrame:
    """Add to every row of an aggregate global aggregates of its columns.

    A window without partitions would gather all groups in one task, and joining a second aggregate
    would compute ``groups``, with the scans and joins below it, twice. Here each row also
    contributes to one total row: the contributions of a task merge before the shuffle. Copies of
    the total row, one per bucket, then meet the groups spread over the same buckets. Two shuffles
    of aggregated rows, one pass over the data below. Equal rows travel as one row and its number.
    """
    buckets = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_group = F.col("_is_group")
    both = groups.withColumn("_is_group", F.explode(F.array(F.lit(True), F.lit(False))))
    held = {f"_{i}": name for i, name in enumerate(groups.columns)}
    keys = [F.when(is_group, F.col(name)).alias(key) for key, name in held.items()]
    rows = both.groupBy(is_group, *keys).agg(
        F.count("*").alias("_times"),
        *[value.alias(f"_total_{name}") for name, value in totals.items()]
    )

    own_bucket = F.array(F.pmod(F.hash(*held), F.lit(buckets)))
    all_buckets = F.sequence(F.lit(0), F.lit(buckets - 1))
    spread = rows.withColumn(
        "_bucket", F.explode(F.when(is_group, own_bucket).otherwise(all_buckets))
    )
    bucket = Window.partitionBy("_bucket")
    met = spread.select(
        is_group,
        "_times",
        *[F.col(key).alias(name) for key, name in held.items()],
        *[
            F.max(F.when(~is_group, F.col(f"_total_{name}"))).over(bucket).alias(name)
            for name in totals
        ],
    )
    again = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return met.where(is_group).withColumn("_again", again).drop("_is_group", "_times", "_again")


def with_share(groups: DataFrame, value: str, out: str) -> DataFrame:
    """Add each group's percentage of the sum of ``value``, rounded to 2 decimals."""
    shared = with_totals(groups, _whole=F.sum(value))
    return shared.withColumn(out, share_pct(F.col(value), F.col("_whole"))).drop("_whole")


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows in ``order``: each task keeps k rows, then the best of these stay."""
    return df.orderBy(*order).limit(k)


def with_running_share(
    groups: DataFrame, key: str, value: str, folder: str, total: str = "_whole", running: str = "_running"
) -> DataFrame:
    """Add the sum of ``value`` and its running sum from the largest value down, ties by ``key``, null last.

    For any number of groups: they are sorted over all tasks and written to ``folder`` once. Each part's sum
    is known then, and the sums of all parts before it are added to the running sum inside. Only the sums
    of the parts reach the driver. ``folder`` must be shared and new; it stays, as the result reads from it.
    """
    spark = groups.sparkSession
    order = [F.desc_nulls_last(value), F.asc_nulls_first(key)]
    numbered = groups.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered.withColumn("_row", F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder).withColumn("_part", F.shiftright("_row", 33))
    kind = groups.agg(F.sum(value).alias("s")).schema["s"].dataType
    sums, before = [], None
    for part in rows.groupBy("_part").agg(F.sum(value).alias("s")).orderBy("_part").toLocalIterator():
        sums.append((part["_part"], before))
        before = part["s"] if before is None else before if part["s"] is None else before + part["s"]
    parts = spark.createDataFrame(sums, T.StructType([T.StructField("_part", T.LongType()), T.StructField("_before", kind)]))
    inside = F.sum(value).over(Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0))
    summed = F.coalesce(F.col("_before") + F.coalesce(F.col("_inside"), F.lit(0)), F.col("_inside"))
    met = rows.withColumn("_inside", inside).join(parts, "_part")
    return met.select(*groups.columns, F.lit(before).cast(kind).alias(total), summed.cast(kind).alias(running))
