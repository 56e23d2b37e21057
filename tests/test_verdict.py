"""Rows that must not be lost or misplaced."""

import pytest

from tallybook import sinks
from tallybook.operators.share import with_share
from tallybook.plans.cleaning import clean_table, cleaning_report
from tallybook.plans.reporting import monthly_trend
from tallybook.session import shuffle_partitions
from tallybook.sources import read_csv_source
from tests.conftest import rows


def write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_files_with_columns_in_another_order_and_a_blank_header(spark, tmp_path):
    path = write(tmp_path / "in", one="a,b,\n1,2,3\n", two="b,a,\n5,4,6\n")
    got = read_csv_source(spark, path)
    assert rows(got.select("a", "b", "`Unnamed: 2`"), "a") == [("1", "2", "3"), ("4", "5", "6")]


def test_files_with_other_columns_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="differ in their columns"):
        read_csv_source(spark, write(tmp_path / "in", one="a,b\n1,2\n", two="a,c\n1,2\n"))


def test_surplus_cells_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="more cells than its header"):
        read_csv_source(spark, write(tmp_path / "in", one="a,b\n1,2,3\n")).collect()


def test_quoted_line_ends_stay_in_their_cell(spark, tmp_path):
    got = read_csv_source(spark, write(tmp_path / "in", one='a,b\n1,"two\nlines"\n'))
    assert rows(got) == [("1", "two\nlines")]


def test_cells_that_do_not_fit_a_declared_type_keep_their_rows(spark):
    raw = spark.createDataFrame([("5",), ("x",), ("y",), ("y",)], "qty string")
    assert clean_table(raw, types={"qty": "bigint"}).count() == 3
    report = cleaning_report("t", raw, types={"qty": "bigint"}).first()
    assert (report["clean_rows"], report["empty_rows_removed"], report["duplicates_removed"]) == (3, 0, 1)
    assert report["warnings"] == ["2 unparsed in qty"] and report["null_fills"] == {}


def test_equal_groups_keep_their_share(spark):
    groups = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v long")
    assert rows(with_share(groups, "v", "pct"), "k") == [("a", 1, 25.0), ("a", 1, 25.0), ("b", 2, 50.0)]


def test_trend_keeps_equal_rows_and_fails_without_months(spark):
    months = spark.createDataFrame([("2022-04", 1.0), ("2022-04", 1.0)], "order_month string, v double")
    assert monthly_trend(months).count() == 2
    with pytest.raises(Exception, match="is a month in a known form"):
        monthly_trend(spark.createDataFrame([("soon", 1.0)], "order_month string, v double")).collect()


def test_a_repeated_run_archives_once(spark, tmp_path):
    for _ in range(2):
        sinks.latest_and_archive(spark.range(3), str(tmp_path), "t", "20220101_000000")
    sinks.latest_and_archive(spark.range(3), str(tmp_path), "t", "20220102_000000")
    assert spark.read.parquet(f"{tmp_path}/archive/t").count() == 6


def test_partitions_grow_with_the_input():
    assert shuffle_partitions(100 * 10**12) >= 745_000  # 128 MiB each
    assert shuffle_partitions(1) == 200


def test_a_broken_source_does_not_stop_the_others(spark, tmp_path):
    sinks.write_cleaned(spark.range(2), f"{tmp_path}/good_cleaned", "csv")
    (tmp_path / "bad_cleaned").mkdir()
    (tmp_path / "bad_cleaned" / "x.parquet").write_text("no parquet")
    got = sinks.load_all(spark, str(tmp_path), {"bad": "t_bad", "good": "t_good"}, as_view=True)
    assert got["t_good"] == "loaded" and got["t_bad"].startswith("failed")

