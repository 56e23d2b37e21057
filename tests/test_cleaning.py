"""The cleaning operators and their traps, on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybook import operators as op
from tallybook.plans import cleaning
from tests.conftest import rows


def clean_one(spark, column, values, kind="string", **options):
    df = spark.createDataFrame([(v,) for v in values], f"`{column}` {kind}")
    return [r[0] for r in op.clean_values(df, **options).collect()]


def test_standard_names(spark):
    df = spark.createDataFrame([(1,) * 6], [" Ship-State X ", "Unnamed: 22", "A-B", "AB", "ab", "É d"])
    assert op.standardize_columns(df).columns == [
        "shipstate_x",
        "unnamed_22",
        "ab",
        "ab_2",
        "ab_3",
        "é_d",
    ]


def test_copies_compare_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "a int, b string")
    assert sorted(rows(op.deduplicate(df)), key=repr) == [(1, "a"), (1, None), (None, None)]
    counted = op.deduplicate(df, copies="n")
    assert sorted(rows(counted), key=repr) == [(1, "a", 1), (1, None, 2), (None, None, 1)]


def test_a_row_number_hides_copies_unless_ignored(spark):
    data = [(3, "a", 1), (2, "a", 1), (1, "b", None), (0, "b", None)]
    df = spark.createDataFrame(data, "index int, x string, y int")
    assert op.deduplicate(df).count() == 4
    kept = op.deduplicate(df, ignore=["index"])
    assert kept.columns == ["index", "x", "y"]
    assert rows(kept, "index") == [(0, "b", None), (2, "a", 1)]
    counted = op.deduplicate(df, ignore=(c for c in ["index"]), copies="n")
    assert rows(counted, "index") == [(0, "b", None, 2), (2, "a", 1, 2)]


def test_empty_rows(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, "")], "a int, b string")
    assert op.drop_empty_rows(df).count() == 2
    assert rows(op.count_removed(df.union(df))) == [(6, 2, 3, 1)]


def test_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert rows(op.count_removed(df)) == [(0, 0, 0, 0)]


def test_types_need_every_value(spark):
    data = [("1", "1.5", "True", "x", None, "7", "9" * 30), (" 2", "2", "FALSE", "1", None, None, "1")]
    df = spark.createDataFrame(data, "i string, d string, b string, s string, n string, h string, big string")
    assert op.infer_types(df) == {
        "i": "bigint",
        "d": "double",
        "b": "boolean",
        "s": "string",
        "n": "double",
        "h": "bigint",
        "big": "double",
    }


def test_a_boolean_with_gaps_stays_text(spark):
    df = spark.createDataFrame([("True",), (None,)], "b string")
    assert op.infer_types(df) == {"b": "string"}


def test_blank_text_is_not_a_null(spark):
    assert clean_one(spark, "courier", [None, "  \t", " x\n"]) == ["Unknown", "", "x"]


def test_fills_by_type(spark):
    df = spark.createDataFrame(
        [(None, None, None, None)], "t string, n bigint, d date, b boolean"
    )
    assert rows(op.clean_values(df)) == [("Unknown", 0, None, None)]


@pytest.mark.parametrize("name", ["amount", "total_revenue", "sales", "price_x", "mrp_old"])
def test_money(spark, name):
    given = [" ₹ 1,234.50", "₹4.00", "Rs 0.15/- Per Day", "-3095", "1d", "NaN", "1e3", None]
    assert clean_one(spark, name, given) == [1234.5, 4.0, 0, 0, 0, 0, 1000.0, 0]


def test_money_that_is_a_number_already(spark):
    assert clean_one(spark, "amount", [2.5, -1.0, float("nan"), None], "double") == [2.5, 0, 0, 0]
    assert clean_one(spark, "price", [3, -4, None], "bigint") == [3, 0, 0]


def test_a_channel_is_not_money_unless_asked(spark):
    assert clean_one(spark, "sales_channel", ["Amazon.in "]) == ["Amazon.in"]
    assert clean_one(spark, "sales_channel", ["Amazon.in"], legacy_substring=True) == [0.0]


def test_a_sales_date_is_not_money_unless_asked(spark):
    assert clean_one(spark, "sales_date", ["04-30-22"]) == [dt.date(2022, 4, 30)]
    assert clean_one(spark, "sales_date", ["04-30-22"], legacy_substring=True) == [0.0]


def test_unreadable_dates_stay_null(spark):
    assert clean_one(spark, "order_date", ["04-30-22", "someday", None]) == [
        dt.date(2022, 4, 30),
        None,
        None,
    ]


def test_time_columns_keep_the_clock(spark):
    got = clean_one(spark, "ship_time", ["2022-04-30 10:11:12", "04-30-22"])
    assert got == [dt.datetime(2022, 4, 30, 10, 11, 12), dt.datetime(2022, 4, 30)]


def test_codes_and_places(spark):
    assert clean_one(spark, "sku_code", [" an201-red-l "]) == ["AN201-RED-L"]
    assert clean_one(spark, "shipstate", [" PUNJAB/mohali", None, "rj"]) == [
        "Punjab/Mohali",
        "Unknown",
        "Rj",
    ]
    assert clean_one(spark, "size_category", [1, None], "bigint") == ["1", "0"]


def test_misspelt_states_are_kept_apart(spark):
    given = ["Rajshthan", "Rajsthan", "RJ", "Orissa", "Odisha"]
    assert clean_one(spark, "state", given) == ["Rajshthan", "Rajsthan", "Rj", "Orissa", "Odisha"]


RAW = [
    ("1", "o1", "04-30-22", "a-1", "SET", "₹ 1,000.00", "2", "MUMBAI", "True"),
    ("1", "o1", "04-30-22", "a-1", "SET", "₹ 1,000.00", "2", "MUMBAI", "True"),
    ("2", "o2", "never", None, "kurta", None, None, None, "False"),
    (None,) * 9,
    (None,) * 9,
]
RAW_SCHEMA = (
    "index string, `Order ID` string, Date string, SKU string, Category string, Amount string,"
    " Qty string, `ship-city` string, B2B string"
)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, RAW_SCHEMA)


def test_whole_table(raw):
    clean = cleaning.clean_table(raw)
    assert [f.dataType.simpleString() for f in clean.schema] == [
        "bigint",
        "string",
        "date",
        "string",
        "string",
        "double",
        "bigint",
        "string",
        "string",
    ]
    assert rows(clean, "index") == [
        (1, "o1", dt.date(2022, 4, 30), "A-1", "Set", 1000.0, 2, "Mumbai", "True"),
        (2, "o2", None, "UNKNOWN", "Kurta", 0.0, 0, "Unknown", "False"),
    ]


def test_cleaning_again_changes_no_value(raw):
    clean = cleaning.clean_table(raw)
    again = cleaning.clean_table(clean, types={})
    assert again.columns == clean.columns
    assert rows(again, "index") == rows(clean, "index")


REPORT = {
    "raw_rows": 5,
    "clean_rows": 2,
    "duplicates_removed": 2,
    "empty_rows_removed": 1,
    "null_fills": {"sku": 1, "amount": 1, "qty": 1, "shipcity": 1},
    "warnings": ["1 unparsed in date"],
    "success": True,
    "error": "",
}


def check_report(row):
    assert {key: row[key] for key in REPORT} == REPORT
    assert row["columns"][:3] == ["index", "order_id", "date"]


def test_report(raw):
    check_report(cleaning.cleaning_report("orders", raw).collect()[0])


def test_report_of_the_writing_run(spark, raw, tmp_path):
    report = cleaning.clean_and_write("orders", raw, str(tmp_path / "out"))
    check_report(report.collect()[0])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_all_sources_in_one_run(spark, raw, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("Order ID,Amount,Qty\no1,₹ 5,1\no1,₹ 5,1\no2,,x\n")
    bad.write_text("")
    sources = {"good": str(good), "gone": str(tmp_path / "gone.csv"), "bad": str(bad)}
    report = {r["name"]: r for r in cleaning.clean_all(spark, sources, str(tmp_path)).collect()}
    assert (report["good"]["success"], report["good"]["duplicates_removed"]) == (True, 1)
    assert report["good"]["null_fills"] == {"amount": 1}
    assert report["gone"]["error"].startswith("nothing to read")
    assert not report["bad"]["success"] and report["bad"]["error"]
    kept = spark.read.parquet(str(tmp_path / "good_cleaned"))
    assert rows(kept, "order_id") == [("o1", 5.0, "1"), ("o2", 0.0, "x")]


def test_declared_form(spark):
    df = spark.createDataFrame(
        [("o1", dt.date(2022, 4, 30), 10.125, "2", True), ("o2", None, None, "x", None)],
        "order_id string, date date, amount double, qty string, b2b boolean",
    )
    missing = "status fulfilment sales_channel shipservicelevel sku category size courier_status"
    for name in (missing + " shipcity shipstate shipcountry").split():
        df = df.withColumn(name, F.lit("x"))
    sales = cleaning.as_sales_orders(df)
    assert sales.schema["amount"].dataType.simpleString() == "decimal(18,2)"
    got = rows(sales.select("order_date", F.col("amount").cast("string"), "qty"), "order_id")
    assert got == [(dt.date(2022, 4, 30), "10.13", 2), (None, None, None)]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c date")
    assert rows(op.null_profile(df), "column_name") == [("b", 1), ("c", 2)]


def test_stringify_keeps_nulls(spark):
    df = spark.createDataFrame([([1, 2], None, 3)], "a array<int>, b string, c int")
    assert rows(op.stringify_objects(df)) == [("[1, 2]", None, 3)]


def test_a_source_without_rows(spark, tmp_path):
    empty = tmp_path / "empty.csv"
    empty.write_text("Order ID,Amount\n")
    blank = tmp_path / "blank.csv"
    blank.write_text("Order ID,Amount\n,\n,\n")
    sources = {"empty": str(empty), "blank": str(blank)}
    report = {r["name"]: r for r in cleaning.clean_all(spark, sources, str(tmp_path)).collect()}
    counts = ("raw_rows", "clean_rows", "duplicates_removed", "empty_rows_removed")
    assert [report["empty"][c] for c in counts] == [0, 0, 0, 0]
    assert [report["blank"][c] for c in counts] == [2, 0, 1, 1]
    assert report["empty"]["success"] and report["blank"]["success"]
    assert spark.read.parquet(str(tmp_path / "blank_cleaned")).count() == 0


def test_cleaning_limits_methods_to_what_the_jvm_compiles(spark, conf, tmp_path):
    limit = "spark.sql.codegen.hugeMethodLimit"
    names = ["a_date", "b_date"]
    raw = spark.createDataFrame([(f"2022-01-{i:02}",) * 2 for i in range(1, 5)], names)
    conf(spark__sql__codegen__hugeMethodLimit="65535")
    assert cleaning.clean_table(raw, types={}).count() == 4 and spark.conf.get(limit) == "8000"
    spark.conf.set(limit, "65535")
    raw.write.option("header", True).csv(f"{tmp_path}/raw")
    assert cleaning.clean_all(spark, {"s": f"{tmp_path}/raw"}, f"{tmp_path}/out").first()["clean_rows"] == 4
    assert spark.conf.get(limit) == "8000"
    spark.conf.set(limit, "20000")
    assert cleaning.clean_table(raw, types={}).where(f"{names[1]} = date'2022-01-02'").count() == 1
    assert spark.conf.get(limit) == "20000"
