"""Cleaned tables to named tables: the session catalog, or an external database."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallybook.sinks.files import CSV_OPTIONS
from tallybook.operators import stringify_objects

# Which cleaned source fills which table, and rows per insert statement.
TABLES = {
    "amazon_sales": "sales_orders",
    "sale_report": "products",
    "pnl": "financials",
    "international_sales": "inventory",
}
INSERT_ROWS = 5000


def loader_columns(df: DataFrame) -> DataFrame:
    """Names for the table: like the standard ones, but only plain spaces turn into ``_``."""
    return df.toDF(
        *[re.sub(r"\W", "", c.strip().lower().replace(" ", "_")) for c in df.columns]
    )


def load_table(df: DataFrame, name: str, as_view: bool = False) -> DataFrame:
    """Replace table ``name`` (or a temporary view) with ``df`` and return it."""
    loaded = stringify_objects(loader_columns(df))
    if as_view:
        loaded.createOrReplaceTempView(name)
    else:
        loaded.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def load_all(
    spark: SparkSession,
    clean_root: str,
    tables: Mapping[str, str] = TABLES,
    as_view: bool = False,
) -> dict[str, str]:
    """Load every cleaned source that is there; returns what happened, by table."""
    outcome = {}
    for source, table in tables.items():
        path = f"{clean_root}/{source}_cleaned"
        try:
            load_table(_cleaned(spark, path), table, as_view)
            outcome[table] = "loaded"
        except Exception as error:  # one bad source must not stop the rest
            missing = isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
            outcome[table] = f"nothing at {path}; clean this source first" if missing else f"failed: {error}"
    return outcome


def _cleaned(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned table as it was written, Parquet or CSV, by the ending of its files."""
    heads = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    if heads.isEmpty():
        return spark.read.options(**CSV_OPTIONS).csv(path)
    return spark.read.parquet(path)


def write_database(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
) -> None:
    """Replace a database table over JDBC, in multi-row batches over at most ``connections`` at once."""
    loaded = stringify_objects(loader_columns(df))
    options = {"url": url, "dbtable": table, "batchsize": str(INSERT_ROWS), "numPartitions": str(connections), **(properties or {})}
    loaded.write.format("jdbc").options(**options).mode("overwrite").save()
