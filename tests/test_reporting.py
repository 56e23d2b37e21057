"""Report tables from KPI results."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from tallybook.plans import reporting
from tests.conftest import rows
from tests.test_kpi import CATEGORIES

# Published revenue of the five largest states, and of all states.
STATES = [
    ("Maharashtra", "13335534.14"),
    ("Karnataka", "10481114.37"),
    ("Telangana", "6916615.65"),
    ("Uttar Pradesh", "6816642.08"),
    ("Tamil Nadu", "6515650.11"),
]
ALL_REVENUE = "78592678.3"


def months(spark, values):
    data = [(v, float(i)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "order_month string, monthly_revenue double")


@pytest.mark.parametrize(
    "given",
    [
        ["2022-05", "2022-04"],
        ["2022-05-01", "2022-04-01"],
        ["05/2022", "04/2022"],
        ["05-2022", "4-2022"],
    ],
)
def test_trend_reads_each_format(spark, given):
    got = rows(reporting.monthly_trend(months(spark, given)))
    assert [(r[2], r[3]) for r in got] == [
        (dt.date(2022, 4, 1), "Apr 2022"),
        (dt.date(2022, 5, 1), "May 2022"),
    ]


def test_trend_takes_rows_one_by_one_when_no_format_fits_all(spark):
    got = rows(reporting.monthly_trend(months(spark, ["2022-05", "04/2022", "soon", None])))
    assert [(r[0], r[3]) for r in got] == [("04/2022", "Apr 2022"), ("2022-05", "May 2022")]


def test_trend_ignores_missing_months_when_choosing(spark):
    got = rows(reporting.monthly_trend(months(spark, ["2022-05", None])))
    assert [r[3] for r in got] == ["May 2022"]


def test_top_states_are_shown_least_first(spark):
    data = [(f"s{i:02}", float(i)) for i in range(12)] + [(None, 5.0)]
    df = spark.createDataFrame(data, "state string, total_revenue double")
    got = rows(reporting.top_states(df))
    assert [r[1] for r in got] == sorted(r[1] for r in got)
    assert got[0] == ("s03", 3.0) and got[-1] == ("s11", 11.0) and len(got) == 10


def test_ranking_ascends(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "category string, total_revenue double")
    assert rows(reporting.category_ranking(df)) == [("b", 1.0), ("a", 2.0)]


def test_product_table(spark):
    data = [("J0230-SKD-M – a very long name…", 468, 527699.5, 1127.5), ("B", None, 2.5, None)]
    df = spark.createDataFrame(
        data, "sku string, units_sold bigint, total_revenue double, avg_unit_price double"
    )
    table = reporting.top_products_table(df)
    assert table.columns == ["Product / SKU", "Revenue (USD)", "Units Sold", "Avg Price (USD)"]
    assert rows(table) == [
        ("J0230-SKD-M - a very l", "$527,700", "468", "$1,128"),
        ("B", "$2", None, None),
    ]


def test_product_table_finds_other_names(spark):
    data = [("Kurta", "Set", "1999.9", "3.7"), ("Top", "Set", "n/a", "2")]
    df = spark.createDataFrame(data, "item string, Main_Category string, Revenue string, qty string")
    table = reporting.top_products_table(df)
    assert table.columns == ["Product / SKU", "Category", "Revenue (USD)", "Units Sold"]
    assert sorted(rows(table)) == [("Kurta", "Set", "$2,000", "3"), ("Top", "Set", "n/a", "2")]


def test_product_table_needs_a_known_column(spark):
    with pytest.raises(ValueError, match="No recognised product columns"):
        reporting.top_products_table(spark.createDataFrame([(1,)], "x int"))


def test_known_concentration_of_categories(spark):
    data = [(c, Decimal(r)) for c, r, _ in CATEGORIES]
    df = spark.createDataFrame(data, "category string, total_revenue decimal(18,2)")
    got = rows(reporting.concentration_report(df, "category"), "rank")
    assert [r[0] for r in got] == [1, 2, 3, 4, 5]
    assert [(r[1], r[3]) for r in got] == [(c, pct) for c, _, pct in CATEGORIES[:5]]
    assert got[-1][4] == 99.07


def test_known_concentration_of_states(spark):
    rest = Decimal(ALL_REVENUE) - sum(Decimal(r) for _, r in STATES)
    data = [(s, Decimal(r)) for s, r in STATES]
    data += [(f"rest {i}", rest / 20) for i in range(20)]
    df = spark.createDataFrame(data, "state string, total_revenue decimal(18,4)")
    last = rows(reporting.concentration_report(df, "state"), "rank")[-1]
    assert last[1] == "Tamil Nadu" and last[4] == pytest.approx(56.07, abs=0.011)


def test_narrative(spark):
    df = spark.createDataFrame([("é" * 5000 + "…x",), ("ok — “fine”",)], "text string")
    long, short = [r[0] for r in reporting.narrative_text(df, "text").collect()]
    assert long.startswith("é" * 5000 + "\n\n[...Report truncated") and short == 'ok - "fine"'
