"""Dates in more forms, declared types that cut nothing, and options by source."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybook.functions.dates import parse_date, parse_timestamp
from tallybook.operators.values import apply_schema, unfit_counts
from tallybook import sources
from tallybook.plans import kpi
from tallybook.plans.cleaning import clean_all
from tallybook.plans.export import export_all
from tallybook.sources.database import read_database
from tests.conftest import SMALL, rows

DAY = dt.date(2022, 4, 30)


@pytest.mark.parametrize(
    "text",
    [
        "2022-04-30T10:11:12",
        "2022-04-30T10:11:12Z",
        "2022-04-30 10:11:12+05:30",
        "2022-04-30 10:11",
        "2022-04-30 10:11:12.5",
        "2022-4-30 1:02:03",
        "04/30/22",
        "2022/04/30",
        "30-Apr-2022",
        "30 apr 2022",
        "30 April 2022",
        "Apr 30, 2022",
        "April 30, 2022",
        "4/30/2022",
        "04-30-22",
    ],
)
def test_date_forms(spark, text):
    assert spark.range(1).select(parse_date(F.lit(text))).first()[0] == DAY


@pytest.mark.parametrize("text", ["2022-04-31T10:11:12", "2022-04-30 25:00", "31-Feb-2022", "30-Abc-2022", "soon", "2022/13/01"])
def test_texts_that_are_no_date(spark, text):
    assert spark.range(1).select(parse_date(F.lit(text))).first()[0] is None


@pytest.mark.parametrize(
    ("text", "at"),
    [
        ("2022-04-30T10:11:12.5", dt.datetime(2022, 4, 30, 10, 11, 12, 500000)),
        ("2022-04-30 10:11", dt.datetime(2022, 4, 30, 10, 11)),
        ("2022-04-30 10:11:12+05:30", dt.datetime(2022, 4, 30, 10, 11, 12)),
        ("04/30/22", dt.datetime(2022, 4, 30)),
    ],
)
def test_timestamps(spark, text, at):
    assert spark.range(1).select(parse_timestamp(F.lit(text))).first()[0] == at


def test_declared_types_cut_nothing_and_are_counted(spark):
    given = spark.createDataFrame([(1.5, "2022-04-30"), (2.0, "x"), (None, None)], "`q.ty` double, day string")
    names = {"qty": "q.ty"}
    assert apply_schema(given, "qty bigint, day date", names).collect() == [(None, DAY), (2, None), (None, None)]
    assert rows(unfit_counts(given, "qty bigint, day date", names), "column_name") == [("day", 1), ("qty", 1)]
    with pytest.raises(ValueError, match="no column for a, b"):
        apply_schema(given, "a int, b int, day date")


def test_options_by_source(spark, tmp_path):
    (tmp_path / "in.csv").write_text("index,sales_channel,v\n0,web,1\n1,web,1\n")
    sources = {"s": str(tmp_path / "in.csv")}
    report = clean_all(spark, sources, str(tmp_path / "out"), options={"s": {"ignore": ["index"], "encoding": "UTF-8"}})
    assert report.select("raw_rows", "clean_rows", "duplicates_removed").first() == (2, 1, 1)
    clean_all(spark, sources, str(tmp_path / "old"), options={"s": {"legacy_substring": True}})
    assert spark.read.parquet(str(tmp_path / "old/s_cleaned")).first()["sales_channel"] == 0
    with pytest.raises(ValueError, match="unknown options"):
        clean_all(spark, sources, str(tmp_path / "x"), options={"s": {"speed": 1}})


def test_own_staging_is_removed(spark, tmp_path):
    sales = sources.sales_orders(spark, SMALL)
    some = {"monthly_revenue": kpi.EXPORTS["monthly_revenue"]}
    report = export_all(sales, str(tmp_path / "out"), some, staging=str(tmp_path / "staged"))
    assert report.first()["success"] and not list((tmp_path / "staged").iterdir())


def test_a_partitioned_database_read_needs_its_bounds(spark):
    with pytest.raises(ValueError, match="needs bounds"):
        read_database(spark, "jdbc:none", "select 1", partition_column="id")
