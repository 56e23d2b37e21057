"""Optional external database, through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Run ``query`` in the database, in one task; with a numeric ``partition_column`` in many at once.

    That needs its ``bounds``, which split the range and drop no rows, and the number of ``partitions``.
    """
    if partition_column is not None and (bounds is None or not partitions):
        raise ValueError("a partition column needs bounds and a number of partitions")
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if partition_column is None:
        return reader.option("query", query).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) source")
        .option("partitionColumn", partition_column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )
