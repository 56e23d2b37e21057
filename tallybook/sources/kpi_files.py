"""Exported KPI files, read back with declared types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# The columns of every exported KPI. The month stays text.
KPI_SCHEMAS = {
    "executive_summary": (
        "total_orders bigint, total_units_sold bigint, total_revenue double, avg_order_value double,"
        " active_states bigint, active_cities bigint, product_categories bigint, unique_products bigint"
    ),
    "monthly_revenue": "order_month string, monthly_revenue double",
    "category_performance": (
        "category string, total_orders bigint, units_sold bigint, total_revenue double,"
        " revenue_share_pct double"
    ),
    "top_products": (
        "sku string, units_sold bigint, total_revenue double, avg_unit_price double"
    ),
    "state_performance": (
        "state string, total_orders bigint, total_revenue double, avg_order_value double,"
        " revenue_share_pct double"
    ),
    "customer_segments": (
        "customer_segment string, total_orders bigint, total_revenue double,"
        " avg_order_value double, revenue_share_pct double"
    ),
    "cancellation_analysis": (
        "status string, total_orders bigint, revenue double, order_share_pct double"
    ),
    "top_cities": "city string, total_orders bigint, total_revenue double",
    "courier_performance": "courier_status string, total_orders bigint, total_revenue double",
    "fulfillment_performance": (
        "fulfillment_channel string, total_orders bigint, total_revenue double,"
        " avg_order_value double"
    ),
    "sales_channel_performance": (
        "sales_channel string, total_orders bigint, total_revenue double, avg_order_value double"
    ),
}


def read_kpi_typed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One exported KPI with its declared types."""
    reader = spark.read.schema(KPI_SCHEMAS[name]).option("header", True).option("escape", '"')
    # With a null text that no cell holds, an empty cell is null and a quoted empty one is not.
    reader = reader.option("nullValue", "\x00")
    try:
        return reader.csv(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no {name} under {root}; export the KPIs first") from error
        raise


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Pass ``df`` on, or fail when it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows; export it again")
    return df


def read_kpi_files(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """All named KPIs; the first one that is missing or empty stops the run."""
    return {name: require_rows(read_kpi_typed(spark, root, name), name) for name in names}
