"""KPIs on hand-made lines, on known results, and as invariants of the given tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import with_share
from tallybook.plans import kpi
from tallybook.plans.cleaning import SALES_SCHEMA
from tallybook.sources import KPI_SCHEMAS, sales_orders
from tests.conftest import SMALL, rows

# Published results, as (group, revenue, share of revenue).
CATEGORIES = [
    ("Set", "39204124.03", 49.88),
    ("Kurta", "21299546.7", 27.1),
    ("Western Dress", "11216072.69", 14.27),
    ("Top", "5347792.3", 6.8),
    ("Ethnic Dress", "791217.66", 1.01),
    ("Blouse", "458408.18", 0.58),
    ("Bottom", "150667.98", 0.19),
    ("Saree", "123933.76", 0.16),
    ("Dupatta", "915.0", 0.0),
]
# Published results, as (status, lines, share of lines).
STATUSES = [
    ("Shipped", 77804, 60.32),
    ("Shipped - Delivered to Buyer", 28769, 22.31),
    ("Cancelled", 18332, 14.21),
    ("Shipped - Returned to Seller", 1953, 1.51),
    ("Shipped - Picked Up", 973, 0.75),
    ("Pending", 658, 0.51),
    ("Pending - Waiting for Pick Up", 281, 0.22),
    ("Shipped - Returning to Seller", 145, 0.11),
    ("Shipped - Out for Delivery", 35, 0.03),
    ("Shipped - Rejected by Buyer", 11, 0.01),
    ("Shipping", 8, 0.01),
    ("Shipped - Lost in Transit", 5, 0.0),
    ("Shipped - Damaged", 1, 0.0),
]
# Published results, as (sku, units, revenue, average unit price).
PRODUCTS = [
    ("J0230-SKD-M", 468, "527699.2", 1127.56),
    ("JNE3797-KR-L", 661, "524581.77", 793.62),
    ("J0230-SKD-S", 421, "479937.14", 1139.99),
    ("JNE3797-KR-M", 561, "454290.16", 809.79),
    ("JNE3797-KR-S", 503, "407302.57", 809.75),
    ("JNE3797-KR-XL", 415, "332155.24", 800.37),
    ("J0230-SKD-L", 272, "305616.95", 1123.59),
    ("JNE3797-KR-XS", 386, "303616.7", 786.57),
    ("SET268-KR-NP-XL", 373, "284058.96", 761.55),
    ("JNE3797-KR-XXXL", 353, "276375.8", 782.93),
]

# order, day, status, sku, category, qty, amount, state, b2b
LINES = [
    ("o1", dt.date(2022, 4, 1), "Shipped", "A", "Set", 2, "100.00", "Goa", True),
    ("o1", dt.date(2022, 4, 1), "Shipped", "B", "Top", 1, "50.00", "Goa", True),
    ("o2", dt.date(2022, 5, 1), "CANCELLED", "A", "Set", 0, None, "Goa", False),
    ("o3", dt.date(2021, 4, 9), "Shipped - Returned", "C", "Top", 1, "50.00", None, None),
    ("o4", None, "Refunded", "D", "Top", 0, "0.00", "Delhi", False),
]


@pytest.fixture(scope="module")
def sales(spark):
    """The lines in the declared form; columns not given are one constant."""
    given = "order_id order_date status sku category qty amount shipstate b2b".split()
    data = [
        tuple(Decimal(v) if given[i] == "amount" and v else v for i, v in enumerate(line))
        for line in LINES
    ]
    types = dict(part.split(" ") for part in SALES_SCHEMA.split(", ") if part)
    df = spark.createDataFrame(data, ", ".join(f"{c} {types[c]}" for c in given))
    return df.withColumns({c: F.lit("x") for c in types if c not in given})


@pytest.fixture(scope="module")
def star(spark):
    return sales_orders(spark, SMALL).cache()


def known(spark, records, schema):
    return spark.createDataFrame(records, schema)


def test_known_revenue_shares(spark):
    df = known(spark, [(c, Decimal(r)) for c, r, _ in CATEGORIES], "c string, r decimal(18,2)")
    got = rows(with_share(df, "r", "pct").orderBy(F.desc("r")).select("c", "pct"))
    assert got == [(c, pct) for c, _, pct in CATEGORIES]


def test_known_line_shares(spark):
    df = known(spark, [(s, n) for s, n, _ in STATUSES], "s string, n bigint")
    got = rows(with_share(df, "n", "pct").orderBy(F.desc("n")).select("s", "pct"))
    assert got == [(s, pct) for s, _, pct in STATUSES]


def test_known_products(spark):
    data = [(s, n, Decimal(r)) for s, n, r, _ in PRODUCTS]
    df = known(spark, data, "sku string, qty bigint, amount decimal(18,2)")
    assert rows(kpi.top_products(df)) == [(s, n, float(r), p) for s, n, r, p in PRODUCTS]


def test_exports_have_their_declared_columns(star):
    for name, export in kpi.EXPORTS.items():
        found = ", ".join(f"{c} {t}" for c, t in export.compute(star).dtypes)
        assert found == KPI_SCHEMAS[name], name


def test_average_is_over_lines_with_an_amount(sales):
    summary = kpi.executive_summary(sales).collect()[0]
    assert summary["total_orders"] == 4
    assert summary["total_revenue"] == 200.0
    assert summary["avg_order_value"] == 50.0
    assert rows(kpi.avg_revenue_per_order(sales)) == [(50.0,)]


def test_orders_that_span_categories_count_in_each(sales):
    got = rows(kpi.category_performance(sales))
    assert got == [("Set", 2, 2, 100.0, 50.0), ("Top", 3, 2, 100.0, 50.0)]


def test_no_units_gives_no_unit_price(sales):
    prices = {r["sku"]: r["avg_unit_price"] for r in kpi.top_products(sales).collect()}
    assert prices == {"A": 50.0, "B": 50.0, "C": 50.0, "D": None}


def test_an_unknown_segment_is_a_second_consumer_row(sales):
    got = rows(kpi.customer_segments(sales).select("customer_segment", "total_revenue"))
    assert got == [("B2B (Business)", 150.0), ("B2C (Consumer)", 50.0), ("B2C (Consumer)", 0.0)]


def test_dates(sales):
    assert rows(kpi.monthly_revenue(sales)) == [
        (None, 0.0),
        ("2021-04", 50.0),
        ("2022-04", 150.0),
        ("2022-05", None),
    ]
    assert rows(kpi.revenue_seasonality(sales)) == [(None, 0.0), (4, 200.0), (5, None)]
    assert rows(kpi.avg_daily_revenue(sales)) == [(66.67,)]


def test_filters_ignore_case(sales):
    assert rows(kpi.state_cancellations(sales)) == [("Goa", 1)]
    assert rows(kpi.returns_refunds(sales)) == [
        ("Refunded", 1, 0.0),
        ("Shipped - Returned", 1, 50.0),
    ]


def test_no_rows(sales):
    none = sales.where(F.lit(False))
    assert rows(kpi.total_revenue(none)) == [(None,)]
    assert rows(kpi.avg_revenue_per_order(none)) == [(None,)]
    assert rows(kpi.state_performance(none)) == []
    assert kpi.executive_summary(none).collect()[0]["total_orders"] == 0


def test_no_revenue_gives_no_share(sales):
    free = sales.withColumn("amount", F.lit(0).cast("decimal(18,2)"))
    assert {r["revenue_share_pct"] for r in kpi.state_performance(free).collect()} == {None}


def test_ties_go_by_key(sales):
    same = sales.withColumn("amount", F.lit(1).cast("decimal(18,2)")).dropDuplicates(["sku"])
    assert [r["sku"] for r in kpi.top_products(same).collect()] == ["A", "B", "C", "D"]


def test_double_amounts_work_too(sales):
    loose = sales.withColumn("amount", F.col("amount").cast("double"))
    for name, one in kpi.KPIS.items():
        assert rows(one.compute(loose)) == rows(one.compute(sales)), name


def test_revenue_is_conserved(star):
    total = kpi.total_revenue(star).first()[0]
    sums = {
        "category_performance": "total_revenue",
        "state_performance": "total_revenue",
        "monthly_revenue": "monthly_revenue",
        "cancellation_analysis": "revenue",
        "courier_performance": "total_revenue",
        "customer_segments": "total_revenue",
        "fulfillment_performance": "total_revenue",
        "sales_channel_performance": "total_revenue",
        "ship_service_level": "total_revenue",
        "demand_by_category_size": "total_revenue",
        "category_state_performance": "total_revenue",
        "revenue_seasonality": "revenue",
    }
    for name, column in sums.items():
        found = kpi.KPIS[name].compute(star).agg(F.sum(column)).first()[0]
        assert found == pytest.approx(total, abs=0.01), name


def test_line_counts_and_shares_add_up(star):
    lines = star.count()
    for name in ("cancellation_analysis", "courier_performance"):
        assert kpi.KPIS[name].compute(star).agg(F.sum("total_orders")).first()[0] == lines
    for name, share in (
        ("category_performance", "revenue_share_pct"),
        ("state_performance", "revenue_share_pct"),
        ("cancellation_analysis", "order_share_pct"),
        ("fulfillment_performance", "order_share_pct"),
    ):
        assert kpi.KPIS[name].compute(star).agg(F.sum(share)).first()[0] == pytest.approx(100, abs=0.2)


def test_orders_add_up_only_where_fixed_per_order(star):
    orders = kpi.executive_summary(star).first()["total_orders"]

    def added(name):
        return kpi.KPIS[name].compute(star).agg(F.sum("total_orders")).first()[0]

    for name in ("state_performance", "customer_segments", "sales_channel_performance"):
        assert added(name) == orders, name
    assert added("category_performance") > orders


def test_approximate_summary_is_close(star):
    exact = kpi.executive_summary(star).first().asDict()
    rough = kpi.executive_summary(star, approximate=0.02).first().asDict()
    assert rough.keys() == exact.keys()
    for name, value in exact.items():
        assert rough[name] == pytest.approx(value, rel=0.1), name
