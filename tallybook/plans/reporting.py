"""Report-ready tables, shaped from KPI results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import month_label, sanitize, share_pct, truncate
from tallybook.operators import top_k, with_totals

# Accepted month texts, as (shape, prefix and suffix that complete a day, format).
MONTH_FORMATS = (
    (r"^\d{4}-\d{1,2}$", "", "-1", "yyyy-M-d"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "", "", "yyyy-M-d"),
    (r"^\d{1,2}/\d{4}$", "1/", "", "d/M/yyyy"),
    (r"^\d{1,2}-\d{4}$", "1-", "", "d-M-yyyy"),
)

# Names a product, or a unit count, may have in a product table.
PRODUCT_NAMES = ("product_name", "sku", "style", "product", "item")
UNIT_NAMES = ("units_sold", "quantity", "qty", "units")
LABEL_LENGTH = 22

# The KPIs a report is made from.
REPORT_KPIS = ("monthly_revenue", "category_performance", "state_performance", "top_products")


def _month_candidates(column: str) -> list[Column]:
    text = F.col(column)
    return [
        F.when(text.rlike(shape), F.try_to_date(F.concat(F.lit(head), text, F.lit(tail)), fmt))
        for shape, head, tail, fmt in MONTH_FORMATS
    ]


def monthly_trend(monthly: DataFrame, month: str = "order_month") -> DataFrame:
    """Months as dates and labels, in time order; rows without a readable month are dropped.

    A table in which no month can be read is an error when the plan runs.

    The first format that reads all months is used. When none does, each row takes the first format
    that reads it. The choice is part of the plan, so nothing runs while the plan is built.
    """
    candidates = {f"_m{i}": c for i, c in enumerate(_month_candidates(month))}
    parsed = monthly.withColumns(candidates)
    failed = {
        f"_bad{i}": F.count_if(F.col(month).isNotNull() & F.col(name).isNull())
        for i, name in enumerate(candidates)
    }
    chosen = F.coalesce(*[F.col(name) for name in candidates])
    judged = with_totals(parsed, _readable=F.count(chosen), **failed)
    for i, name in reversed(list(enumerate(candidates))):
        chosen = F.when(F.col(f"_bad{i}") == 0, F.col(name)).otherwise(chosen)
    none = F.raise_error(F.lit(f"no value of {month} is a month in a known form"))
    return (
        judged.withColumn("order_month_dt", F.when(F.col("_readable") == 0, none.cast("date")).otherwise(chosen))
        .dropna(subset=["order_month_dt"])
        .select(*monthly.columns, "order_month_dt")
        .withColumn("order_month_label", month_label(F.col("order_month_dt")))
        .orderBy("order_month_dt")
    )


def dropped_months(monthly: DataFrame, month: str = "order_month") -> DataFrame:
    """One row: how many rows have no month that can be read, so that ``monthly_trend`` drops them."""
    readable = F.coalesce(*_month_candidates(month))
    return monthly.agg(F.count_if(readable.isNull()).alias("dropped"))


def category_ranking(categories: DataFrame) -> DataFrame:
    """Categories from least to most revenue."""
    return categories.select("category", "total_revenue").orderBy("total_revenue", "category")


def top_states(states: DataFrame, k: int = 10) -> DataFrame:
    """The k states with most revenue, least first."""
    best = top_k(states, k, F.desc("total_revenue"), "state")
    return best.select("state", "total_revenue").orderBy("total_revenue", F.desc("state"))


def top_products_table(products: DataFrame, rows: int = 10) -> DataFrame:
    """Display table of products. Columns are found by name, and those not there are left out."""
    names = products.columns

    def containing(part: str) -> str | None:
        return next((c for c in names if part in c.lower()), None)

    def among(options: Iterable[str]) -> str | None:
        return next((c for c in names if c in options), None)

    product, category = among(PRODUCT_NAMES), containing("category")
    revenue, units, price = containing("revenue"), among(UNIT_NAMES), containing("price")
    shown = [
        (product, "Product / SKU", _label),
        (category, "Category", _label),
        (revenue, "Revenue (USD)", _dollars),
        (units, "Units Sold", _count),
        (price, "Avg Price (USD)", _dollars),
    ]
    cells = [
        show(F.col(name), products.schema[name].dataType).alias(title)
        for name, title, show in shown
        if name is not None
    ]
    if not cells:
        raise ValueError(f"No recognised product columns in {names}")
    order = [F.desc(revenue)] if revenue else []
    order += [F.col(product)] if product else []
    return (top_k(products, rows, *order) if order else products.limit(rows)).select(*cells)


def _label(value: Column, _: T.DataType) -> Column:
    return sanitize(F.left(value.cast("string"), F.lit(LABEL_LENGTH)))


def _dollars(value: Column, data_type: T.DataType) -> Column:
    return _number(value, data_type, lambda n: F.concat(F.lit("$"), F.format_number(n, 0)))


def _count(value: Column, data_type: T.DataType) -> Column:
    return _number(value, data_type, lambda n: F.format_number(n.try_cast("bigint"), 0))


def _number(value: Column, data_type: T.DataType, show) -> Column:
    """Formatted number; a text that is no number is shown as it is."""
    number = value.try_cast("double")
    shown = show(number)
    if isinstance(data_type, T.NumericType):
        return shown
    return sanitize(F.when(number.isNotNull(), shown).otherwise(value.cast("string")))


def narrative_text(reports: DataFrame, column: str) -> DataFrame:
    """Narrative cut to the length a report holds, then made safe for Latin-1."""
    return reports.withColumn(column, sanitize(truncate(F.col(column))))


def concentration_report(
    groups: DataFrame, key: str, value: str = "total_revenue", top_n: int = 5
) -> DataFrame:
    """The ``top_n`` largest groups with their rank, share, and the share of all down to them.

    Only the ``top_n`` rows reach the running window; the total is of all groups.
    """
    exact = groups.select(key, F.col(value).cast("decimal(28,2)").alias(value))
    best = top_k(with_totals(exact, _total=F.sum(value)), top_n, F.desc(value), key)
    order = Window.orderBy(F.desc(value), key)
    running = F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return best.select(
        F.row_number().over(order).alias("rank"),
        F.col(key).alias("member"),
        F.col(value).cast("double").alias("revenue"),
        share_pct(F.col(value), F.col("_total")).alias("share_pct"),
        share_pct(running, F.col("_total")).alias("cumulative_share_pct"),
    )


def report_tables(kpis: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table of the report, from the KPIs it needs."""
    return {
        "monthly_trend": monthly_trend(kpis["monthly_revenue"]),
        "category_ranking": category_ranking(kpis["category_performance"]),
        "top_states": top_states(kpis["state_performance"]),
        "top_products": top_products_table(kpis["top_products"]),
        "category_concentration": concentration_report(kpis["category_performance"], "category"),
        "state_concentration": concentration_report(kpis["state_performance"], "state"),
    }
