"""Writers, the export run and its report."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybook import sinks, sources
from tallybook.plans import export, kpi
from tests.conftest import SMALL, rows


@pytest.fixture(scope="module")
def sales(spark):
    return sources.sales_orders(spark, SMALL).cache()


def test_tables_are_replaced(spark):
    first = spark.createDataFrame([(1, None)], "`Order ID` int, `a-b` string")
    loaded = sinks.load_table(first, "orders_loaded")
    assert loaded.columns == ["order_id", "ab"] and rows(loaded) == [(1, None)]
    second = spark.createDataFrame([("x",)], "`Tab\tName` string")
    assert sinks.load_table(second, "orders_loaded").columns == ["tabname"]
    assert spark.sql("SELECT COUNT(*) FROM orders_loaded").first()[0] == 1


def test_load_all_skips_what_is_missing(spark, tmp_path):
    df = spark.createDataFrame([("A", 1)], "sku_code string, stock int")
    sinks.write_cleaned(df, str(tmp_path / "sale_report_cleaned"))
    outcome = sinks.load_all(spark, str(tmp_path), as_view=True)
    assert outcome["products"] == "loaded" and rows(spark.table("products")) == [("A", 1)]
    others = {t: o for t, o in outcome.items() if t != "products"}
    assert set(others) == {"sales_orders", "financials", "inventory"}
    assert all(o.startswith("nothing at") for o in others.values())


def test_csv_keeps_cells_as_they_are(spark, tmp_path):
    df = spark.createDataFrame([(' a "b", c ', None), ("d\\", "é")], "x string, y string")
    sinks.write_cleaned(df, str(tmp_path / "out"), "csv")
    read = sources.read_csv_source(spark, str(tmp_path / "out"))
    assert rows(read, "x") == rows(df, "x")


def test_small_kpi_is_one_file_in_order(sales, tmp_path):
    result = kpi.state_performance(sales)
    path = Path(sinks.write_kpi(result, str(tmp_path), "state_performance"))
    files = list(path.glob("*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[0] == "state,total_orders,total_revenue,avg_order_value,revenue_share_pct"
    read = sources.read_kpi_typed(sales.sparkSession, str(tmp_path), "state_performance")
    assert rows(read) == rows(result)


def test_latest_is_replaced_and_the_archive_grows(spark, tmp_path):
    for value, run_ts in ((1, "20260505_101500"), (2, "20260506_101500")):
        df = spark.createDataFrame([(value,)], "x int")
        sinks.latest_and_archive(df, str(tmp_path), "k", run_ts)
    assert rows(spark.read.parquet(str(tmp_path / "latest/k"))) == [(2,)]
    archive = spark.read.parquet(str(tmp_path / "archive/k"))
    assert rows(archive, "run_ts") == [(1, "20260505_101500"), (2, "20260506_101500")]


def test_export_run(sales, tmp_path):
    report = export.export_all(sales, str(tmp_path))
    by_name = {r["name"]: r for r in report.collect()}
    assert list(by_name) == list(kpi.EXPORTS)
    for name, row in by_name.items():
        assert row["success"], row["error"]
        read = sources.read_kpi_typed(sales.sparkSession, str(tmp_path), name)
        assert rows(read) == rows(kpi.EXPORTS[name].compute(sales))
        assert row["rows"] == read.count()
    assert export.run_summary(report).first()["succeeded"] == 11


def test_one_failing_kpi_does_not_stop_the_rest(sales, tmp_path):
    broken = kpi.Kpi(lambda df: df.select("no_such_column"), ())
    some = {"broken": broken, "total_revenue": kpi.KPIS["total_revenue"]}
    report = export.export_all(sales, str(tmp_path), some)
    got = {r["name"]: (r["success"], bool(r["error"])) for r in report.collect()}
    assert got == {"broken": (False, True), "total_revenue": (True, False)}
    summary = export.run_summary(report).first()
    assert (summary["succeeded"], summary["total"]) == (1, 2) and summary["total_sec"] >= 0


def shared_tables(spark, name):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).glob(f"tallybook-{name}-*"))


def test_stage_uses_the_shared_folder(spark):
    staged = sinks.stage(spark.range(3), "three")
    assert len(shared_tables(spark, "three")) == 1
    assert rows(staged, "id") == [(0,), (1,), (2,)]


def test_staged_export_reads_the_joins_once(spark, tmp_path):
    before = shared_tables(spark, "sales_orders")
    sales = sources.sales_orders(spark, SMALL)
    some = {k: kpi.EXPORTS[k] for k in ("monthly_revenue", "courier_performance")}
    report = export.export_all(sales, str(tmp_path), some, staged=True)
    assert report.where(F.col("success")).count() == 2
    (new,) = shared_tables(spark, "sales_orders") - before
    staged = spark.read.parquet(str(new))
    assert set(staged.columns) == {"order_date", "amount", "courier_status"}


def test_export_of_no_lines(sales, tmp_path):
    report = export.export_all(sales.where(F.lit(False)), str(tmp_path))
    got = {r["name"]: (r["rows"], r["success"], r["error"]) for r in report.collect()}
    assert got.pop("executive_summary") == (1, True, "")
    assert set(got.values()) == {(0, True, "")}
