"""The exported KPIs from one scan of the order lines.

Grouping sets make partial sums per key, per order and key where distinct orders are counted. A second
aggregation over these small sums gives every group of every KPI, in one table that all exports read.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import month_key, ratio, share_pct
from tallybook.operators import top_k, with_share, with_totals
from tallybook.plans.export import EXPORT_SCHEMA, export_kpi
from tallybook.plans.kpi import TOP_K, Kpi
from tallybook.sinks.files import remove

#: Keys whose KPIs count distinct orders, and keys whose KPIs do not.
BY_ORDER = ("category", "shipstate", "shipcity", "fulfilment", "sales_channel", "b2b")
BY_LINE = ("sku", "status", "courier_status", "order_month")
KEYS = (*BY_ORDER, *BY_LINE)
#: The group of all lines.
EVERYTHING = "everything"
#: Parts of a key's members whose best are found apart.
SHARES = 64
COLUMNS = ("order_id", "order_date", "qty", "amount", *(k for k in KEYS if k != "order_month"))


def kpi_groups(sales: DataFrame) -> DataFrame:
    """One row per key and member: ``key``, one column per key, ``total_orders`` and the sums.

    ``key`` names the key that a row groups by, ``everything`` for the row of all lines. Members may be null.
    Only keys with distinct orders meet the order in the first sums; ``total_orders`` is null for the others.
    """
    lines = sales.select(
        "order_id", "qty", "amount", month_key(F.col("order_date")).alias("order_month"),
        *(k for k in KEYS if k != "order_month"),
    )
    sets = [["order_id"], *(["order_id", k] for k in BY_ORDER), *([k] for k in BY_LINE)]
    # The bits of the grouping id tell which columns a row is not grouped by, the first column's the highest.
    columns = ["order_id", *KEYS]
    partial = lines.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("lines"),
        F.sum("qty").alias("units"),
        F.sum("amount").alias("revenue"),
        F.count("amount").alias("amounts"),
    )

    def number(names: list[str]) -> int:
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in names)

    key = F.lit(None).cast("string")
    for names in sets:
        label = next((c for c in names if c != "order_id"), EVERYTHING)
        key = F.when(F.col("_set") == number(names), F.lit(label)).otherwise(key)
    counts_orders = F.col("key").isin(EVERYTHING, *BY_ORDER)
    groups = partial.withColumn("key", key).groupBy("key", *KEYS).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("lines").alias("lines"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.sum("amounts").alias("amounts"),
    )
    return groups.withColumn("total_orders", F.when(counts_orders, F.col("total_orders")))


def _of(groups: DataFrame, key: str, name: str | None = None, *measures: Column) -> DataFrame:
    return groups.where(F.col("key") == key).select(F.col(key).alias(name or key), *measures)


def _money(name: str) -> dict[str, Column]:
    return {name: F.round(F.col(name), 2).cast("double")}


_REVENUE = "total_revenue"


def _revenue(name: str = _REVENUE) -> Column:
    return F.col("revenue").alias(name)


def _mean() -> Column:
    return ratio(F.col("revenue"), F.col("amounts")).alias("avg_order_value")


def executive_summary(groups: DataFrame) -> DataFrame:
    """Distinct states, cities, categories and products are the groups of their keys that have a name."""
    of_all = F.col("key") == EVERYTHING

    def whole(column: str) -> Column:
        return F.max(F.when(of_all, F.col(column)))

    def members(key: str) -> Column:
        return F.count_if((F.col("key") == key) & F.col(key).isNotNull())

    return groups.agg(
        F.coalesce(whole("total_orders"), F.lit(0)).alias("total_orders"),
        whole("units").alias("total_units_sold"),
        whole("revenue").alias(_REVENUE),
        ratio(whole("revenue"), whole("amounts")).alias("avg_order_value"),
        members("shipstate").alias("active_states"),
        members("shipcity").alias("active_cities"),
        members("category").alias("product_categories"),
        members("sku").alias("unique_products"),
    ).withColumns(_money(_REVENUE))


def monthly_revenue(groups: DataFrame) -> DataFrame:
    months = _of(groups, "order_month", None, _revenue("monthly_revenue"))
    return months.withColumns(_money("monthly_revenue")).orderBy("order_month")


def category_performance(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "category", None, F.col("total_orders"), F.col("units").alias("units_sold"), _revenue())
    shared = with_share(rows, _REVENUE, "revenue_share_pct")
    return shared.withColumns(_money(_REVENUE)).orderBy(F.desc(_REVENUE), "category")


def top_products(groups: DataFrame) -> DataFrame:
    price = ratio(F.col("revenue"), F.col("units")).alias("avg_unit_price")
    rows = _of(groups, "sku", None, F.col("units").alias("units_sold"), _revenue(), price)
    return top_k(rows, TOP_K, F.desc(_REVENUE), "sku").withColumns(_money(_REVENUE))


def state_performance(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "shipstate", "state", F.col("total_orders"), _revenue(), _mean())
    shared = with_share(rows, _REVENUE, "revenue_share_pct")
    return shared.withColumns(_money(_REVENUE)).orderBy(F.desc(_REVENUE), "state")


def customer_segments(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "b2b", None, F.col("total_orders"), _revenue(), _mean())
    label = F.when(F.col("b2b").try_cast("boolean"), "B2B (Business)").otherwise("B2C (Consumer)")
    shared = with_share(rows, _REVENUE, "revenue_share_pct")
    named = shared.select(label.alias("customer_segment"), "total_orders", _REVENUE, "avg_order_value", "revenue_share_pct")
    return named.withColumns(_money(_REVENUE)).orderBy(F.desc(_REVENUE), "customer_segment")


def cancellation_analysis(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "status", None, F.col("lines").alias("total_orders"), _revenue("revenue"))
    shared = with_share(rows, "total_orders", "order_share_pct")
    return shared.withColumns(_money("revenue")).orderBy(F.desc("total_orders"), "status")


def top_cities(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "shipcity", "city", F.col("total_orders"), _revenue())
    return top_k(rows, TOP_K, F.desc(_REVENUE), "city").withColumns(_money(_REVENUE))


def courier_performance(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "courier_status", None, F.col("lines").alias("total_orders"), _revenue())
    return rows.withColumns(_money(_REVENUE)).orderBy(F.desc("total_orders"), "courier_status")


def fulfillment_export(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "fulfilment", "fulfillment_channel", F.col("total_orders"), _revenue(), _mean())
    return rows.withColumns(_money(_REVENUE)).orderBy(F.desc("total_orders"), "fulfillment_channel")


def sales_channel_performance(groups: DataFrame) -> DataFrame:
    rows = _of(groups, "sales_channel", None, F.col("total_orders"), _revenue(), _mean())
    return rows.withColumns(_money(_REVENUE)).orderBy(F.desc(_REVENUE), "sales_channel")


#: The exports, as functions of the groups.
SUITE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "executive_summary": executive_summary,
    "monthly_revenue": monthly_revenue,
    "category_performance": category_performance,
    "top_products": top_products,
    "state_performance": state_performance,
    "customer_segments": customer_segments,
    "cancellation_analysis": cancellation_analysis,
    "top_cities": top_cities,
    "courier_performance": courier_performance,
    "fulfillment_performance": fulfillment_export,
    "sales_channel_performance": sales_channel_performance,
}


def export_suite(sales: DataFrame, root: str, at_once: int = 4) -> DataFrame:
    """Export the suite with one scan of ``sales``; a report row per KPI, as ``export_all`` gives.

    The groups are written once beside the exports, far smaller than the lines, and removed at the end.
    """
    spark = sales.sparkSession
    own = f"{root.rstrip('/')}/_groups-{uuid4().hex}"
    try:
        kpi_groups(sales).write.parquet(own)
        groups = spark.read.parquet(own)

        def run(item: tuple[str, Callable[[DataFrame], DataFrame]]) -> tuple:
            return export_kpi(item[0], Kpi(item[1], COLUMNS), groups, root)

        with ThreadPoolExecutor(at_once) as pool:
            rows = list(pool.map(inheritable_thread_target(spark)(run), SUITE.items()))
    finally:
        remove(spark, own)
    return spark.createDataFrame(rows, EXPORT_SCHEMA)


def concentration_reports(sales: DataFrame, keys: tuple[str, ...], value: str = "amount", top_n: int = 5) -> DataFrame:
    """The ``top_n`` largest members of several keys with rank, share, and the share of all down to them.

    One scan: grouping sets give the sums of all keys, and what is best and what is whole both read these.
    Each task keeps its ``top_n`` of a key before they meet.
    """
    sums = sales.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("_set"), F.sum(value).cast("decimal(28,2)").alias("revenue")
    )
    dimension, member = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, k in enumerate(keys):
        own = F.col("_set") == (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))
        dimension, member = F.when(own, F.lit(k)).otherwise(dimension), F.when(own, F.col(k).cast("string")).otherwise(member)
    groups = sums.select(dimension.alias("dimension"), member.alias("member"), "revenue")
    totals = {f"_total_{i}": F.sum(F.when(F.col("dimension") == k, F.col("revenue"))) for i, k in enumerate(keys)}
    judged = with_totals(groups, **totals)
    total = F.lit(None).cast("decimal(38,2)")
    for i, k in enumerate(keys):
        total = F.when(F.col("dimension") == k, F.col(f"_total_{i}")).otherwise(total)
    return _ranked(judged.select("dimension", "member", "revenue", total.alias("_total")), top_n)


def _ranked(groups: DataFrame, top_n: int) -> DataFrame:
    order = [F.desc("revenue"), F.asc("member")]
    some = Window.partitionBy("dimension", "_share").orderBy(*order)
    best = groups.withColumn("_share", F.pmod(F.hash("member"), F.lit(SHARES))).withColumn("_rank", F.row_number().over(some))
    of_key = Window.partitionBy("dimension").orderBy(*order)
    few = best.where(F.col("_rank") <= top_n).withColumn("rank", F.row_number().over(of_key)).where(F.col("rank") <= top_n)
    running = F.sum("revenue").over(of_key.rowsBetween(Window.unboundedPreceding, 0))
    return few.select(
        "dimension",
        "rank",
        "member",
        F.col("revenue").cast("double").alias("revenue"),
        share_pct(F.col("revenue"), F.col("_total")).alias("share_pct"),
        share_pct(running, F.col("_total")).alias("cumulative_share_pct"),
    )
