"""The KPI suite. Every KPI is a function of the flat ``sales_orders`` table.

``total_orders`` counts distinct orders, except by status and by courier, where it counts lines.
``avg_order_value`` is the mean over lines that have an amount; per order there is
``avg_revenue_per_order``. Money is summed as it is stored, exactly for decimals, and leaves as
double. Sorted results break ties by key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import month_key, parse_date, ratio, strip
from tallybook.operators import top_k, with_share

TOP_K = 10


@dataclass(frozen=True)
class Kpi:
    """A KPI and the ``sales_orders`` columns it reads."""

    compute: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...]


def _orders() -> Column:
    return F.count_distinct("order_id")


def _lines() -> Column:
    return F.count("*")


def _units() -> Column:
    return F.sum("qty")


def _amount() -> Column:
    return F.sum("amount")


def _mean_amount() -> Column:
    return ratio(F.sum("amount"), F.count("amount"))


def _as_money(*names: str) -> dict[str, Column]:
    return {name: F.round(F.col(name), 2).cast("double") for name in names}


def total_revenue(sales: DataFrame) -> DataFrame:
    return sales.agg(_amount().alias("total_revenue")).withColumns(_as_money("total_revenue"))


def monthly_revenue(sales: DataFrame) -> DataFrame:
    months = sales.groupBy(month_key(F.col("order_date")).alias("order_month"))
    return (
        months.agg(_amount().alias("monthly_revenue"))
        .withColumns(_as_money("monthly_revenue"))
        .orderBy("order_month")
    )


def category_performance(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("category").agg(
        _orders().alias("total_orders"),
        _units().alias("units_sold"),
        _amount().alias("total_revenue"),
    )
    return (
        with_share(groups, "total_revenue", "revenue_share_pct")
        .withColumns(_as_money("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_products(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("sku").agg(
        _units().alias("units_sold"),
        _amount().alias("total_revenue"),
        ratio(_amount(), _units()).alias("avg_unit_price"),
    )
    return top_k(groups, TOP_K, F.desc("total_revenue"), "sku").withColumns(
        _as_money("total_revenue")
    )


def state_performance(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy(F.col("shipstate").alias("state")).agg(
        _orders().alias("total_orders"),
        _amount().alias("total_revenue"),
        _mean_amount().alias("avg_order_value"),
    )
    return (
        with_share(groups, "total_revenue", "revenue_share_pct")
        .withColumns(_as_money("total_revenue"))
        .orderBy(F.desc("total_revenue"), "state")
    )


def top_cities(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy(F.col("shipcity").alias("city")).agg(
        _orders().alias("total_orders"), _amount().alias("total_revenue")
    )
    return top_k(groups, TOP_K, F.desc("total_revenue"), "city").withColumns(
        _as_money("total_revenue")
    )


def fulfillment_performance(sales: DataFrame) -> DataFrame:
    """Adds the share of order lines to ``fulfillment_export``."""
    groups = sales.groupBy(F.col("fulfilment").alias("fulfillment_channel")).agg(
        _orders().alias("total_orders"),
        _amount().alias("total_revenue"),
        _mean_amount().alias("avg_order_value"),
        _lines().alias("_lines"),
    )
    return (
        with_share(groups, "_lines", "order_share_pct")
        .drop("_lines")
        .withColumns(_as_money("total_revenue"))
        .orderBy(F.desc("total_orders"), "fulfillment_channel")
    )


def _by_channel(sales: DataFrame, key: str, out: str, first: str) -> DataFrame:
    groups = sales.groupBy(F.col(key).alias(out)).agg(
        _orders().alias("total_orders"),
        _amount().alias("total_revenue"),
        _mean_amount().alias("avg_order_value"),
    )
    return groups.withColumns(_as_money("total_revenue")).orderBy(F.desc(first), out)


def fulfillment_export(sales: DataFrame) -> DataFrame:
    return _by_channel(sales, "fulfilment", "fulfillment_channel", "total_orders")


def sales_channel_performance(sales: DataFrame) -> DataFrame:
    return _by_channel(sales, "sales_channel", "sales_channel", "total_revenue")


def ship_service_level(sales: DataFrame) -> DataFrame:
    return _by_channel(sales, "shipservicelevel", "shipservicelevel", "total_orders")


def cancellation_analysis(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("status").agg(
        _lines().alias("total_orders"), _amount().alias("revenue")
    )
    return (
        with_share(groups, "total_orders", "order_share_pct")
        .withColumns(_as_money("revenue"))
        .orderBy(F.desc("total_orders"), "status")
    )


def courier_performance(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("courier_status").agg(
        _lines().alias("total_orders"), _amount().alias("total_revenue")
    )
    return groups.withColumns(_as_money("total_revenue")).orderBy(
        F.desc("total_orders"), "courier_status"
    )


def customer_segments(sales: DataFrame) -> DataFrame:
    """Grouped by the flag, labelled after: an unknown flag is a second consumer row."""
    groups = sales.groupBy("b2b").agg(
        _orders().alias("total_orders"),
        _amount().alias("total_revenue"),
        _mean_amount().alias("avg_order_value"),
    )
    label = F.when(F.col("b2b").try_cast("boolean"), "B2B (Business)").otherwise("B2C (Consumer)")
    return (
        with_share(groups, "total_revenue", "revenue_share_pct")
        .select(
            label.alias("customer_segment"),
            "total_orders",
            "total_revenue",
            "avg_order_value",
            "revenue_share_pct",
        )
        .withColumns(_as_money("total_revenue"))
        .orderBy(F.desc("total_revenue"), "customer_segment")
    )


def avg_daily_revenue(sales: DataFrame) -> DataFrame:
    days = sales.groupBy("order_date").agg(_amount().alias("daily_revenue"))
    mean = ratio(F.sum("daily_revenue"), F.count("daily_revenue"))
    return days.agg(mean.alias("avg_daily_revenue"))


def demand_by_category_size(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("category", "size").agg(
        _units().alias("total_units_sold"), _amount().alias("total_revenue")
    )
    return groups.withColumns(_as_money("total_revenue")).orderBy(
        F.desc("total_units_sold"), "category", "size"
    )


def avg_revenue_per_order(sales: DataFrame) -> DataFrame:
    return sales.agg(ratio(_amount(), _orders()).alias("avg_revenue_per_order"))


def category_state_performance(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("shipstate", "category").agg(
        _orders().alias("total_orders"),
        _units().alias("units_sold"),
        _amount().alias("total_revenue"),
    )
    return groups.withColumns(_as_money("total_revenue")).orderBy(
        F.desc("total_revenue"), "shipstate", "category"
    )


def state_cancellations(sales: DataFrame) -> DataFrame:
    cancelled = sales.where(F.lower("status").contains("cancel"))
    return (
        cancelled.groupBy("shipstate")
        .agg(_lines().alias("cancelled_orders"))
        .orderBy(F.desc("cancelled_orders"), "shipstate")
    )


def executive_summary(sales: DataFrame, approximate: float | None = None) -> DataFrame:
    """Headline measures. Distinct counts are exact unless ``approximate`` gives an allowed error.

    Exact counts expand each line once per counted column, before the map-side combine; the
    approximate ones are sketches and send one small row per task.
    """

    def distinct(column: str) -> Column:
        if approximate is None:
            return F.count_distinct(column)
        return F.approx_count_distinct(column, approximate)

    return sales.agg(
        distinct("order_id").alias("total_orders"),
        _units().alias("total_units_sold"),
        _amount().alias("total_revenue"),
        _mean_amount().alias("avg_order_value"),
        distinct("shipstate").alias("active_states"),
        distinct("shipcity").alias("active_cities"),
        distinct("category").alias("product_categories"),
        distinct("sku").alias("unique_products"),
    ).withColumns(_as_money("total_revenue"))


def returns_refunds(sales: DataFrame) -> DataFrame:
    status = F.lower("status")
    returned = sales.where(status.contains("return") | status.contains("refund"))
    groups = returned.groupBy("status").agg(
        _lines().alias("returned_orders"), _amount().alias("affected_revenue")
    )
    return groups.withColumns(_as_money("affected_revenue")).orderBy("status")


def revenue_seasonality(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy(F.month("order_date").alias("month_num"))
    return (
        groups.agg(_amount().alias("revenue"))
        .withColumns(_as_money("revenue"))
        .orderBy("month_num")
    )


def concentration_by_state(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("shipstate").agg(_amount().alias("revenue"))
    return (
        with_share(groups, "revenue", "revenue_share_pct")
        .withColumns(_as_money("revenue"))
        .orderBy(F.desc("revenue"), "shipstate")
    )


def date_parse_preview(raw: DataFrame, date: str, *order: str, rows: int = 5) -> DataFrame:
    """First ``rows`` raw date texts in ``order``, with the date each is read as."""
    first = top_k(raw, rows, *order)
    return first.select(F.col(date).alias("date"), parse_date(strip(F.col(date))).alias("parsed"))


KPIS: dict[str, Kpi] = {
    "total_revenue": Kpi(total_revenue, ("amount",)),
    "monthly_revenue": Kpi(monthly_revenue, ("order_date", "amount")),
    "category_performance": Kpi(
        category_performance, ("category", "order_id", "qty", "amount")
    ),
    "top_products": Kpi(top_products, ("sku", "qty", "amount")),
    "state_performance": Kpi(state_performance, ("shipstate", "order_id", "amount")),
    "top_cities": Kpi(top_cities, ("shipcity", "order_id", "amount")),
    "fulfillment_performance": Kpi(
        fulfillment_performance, ("fulfilment", "order_id", "amount")
    ),
    "fulfillment_export": Kpi(fulfillment_export, ("fulfilment", "order_id", "amount")),
    "sales_channel_performance": Kpi(
        sales_channel_performance, ("sales_channel", "order_id", "amount")
    ),
    "cancellation_analysis": Kpi(cancellation_analysis, ("status", "amount")),
    "courier_performance": Kpi(courier_performance, ("courier_status", "amount")),
    "customer_segments": Kpi(customer_segments, ("b2b", "order_id", "amount")),
    "avg_daily_revenue": Kpi(avg_daily_revenue, ("order_date", "amount")),
    "demand_by_category_size": Kpi(
        demand_by_category_size, ("category", "size", "qty", "amount")
    ),
    "avg_revenue_per_order": Kpi(avg_revenue_per_order, ("order_id", "amount")),
    "ship_service_level": Kpi(ship_service_level, ("shipservicelevel", "order_id", "amount")),
    "category_state_performance": Kpi(
        category_state_performance, ("shipstate", "category", "order_id", "qty", "amount")
    ),
    "state_cancellations": Kpi(state_cancellations, ("status", "shipstate")),
    "executive_summary": Kpi(
        executive_summary,
        ("order_id", "qty", "amount", "shipstate", "shipcity", "category", "sku"),
    ),
    "returns_refunds": Kpi(returns_refunds, ("status", "amount")),
    "revenue_seasonality": Kpi(revenue_seasonality, ("order_date", "amount")),
    "concentration_by_state": Kpi(concentration_by_state, ("shipstate", "amount")),
}

# The KPIs an export run writes, in its order. Fulfilment is exported without its share.
EXPORTS: dict[str, Kpi] = {
    "executive_summary": KPIS["executive_summary"],
    "monthly_revenue": KPIS["monthly_revenue"],
    "category_performance": KPIS["category_performance"],
    "top_products": KPIS["top_products"],
    "state_performance": KPIS["state_performance"],
    "customer_segments": KPIS["customer_segments"],
    "cancellation_analysis": KPIS["cancellation_analysis"],
    "top_cities": KPIS["top_cities"],
    "courier_performance": KPIS["courier_performance"],
    "fulfillment_performance": KPIS["fulfillment_export"],
    "sales_channel_performance": KPIS["sales_channel_performance"],
}
