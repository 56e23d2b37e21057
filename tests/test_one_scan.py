"""One scan for all KPIs, running sums over any number of groups, copies by digest, and publication at once."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tallybook import operators as op
from tallybook import sinks, sources
from tallybook.__main__ import main
from tallybook.plans import kpi, reporting, suite
from tests.conftest import SMALL, rows
from tests.plans import final_plan


@pytest.fixture(scope="module")
def sales(spark):
    return sources.sales_orders(spark, SMALL).cache()


def test_the_suite_gives_what_each_kpi_gives(spark, sales):
    # Rows without an order, and a flag that is unknown.
    odd = sales.limit(20).withColumn("order_id", F.lit(None).cast("string")).withColumn("b2b", F.lit(None).cast("boolean"))
    for lines in (sales.unionByName(odd), sales.limit(0)):
        groups = suite.kpi_groups(lines).cache()
        for name, shape in suite.SUITE.items():
            wanted = kpi.EXPORTS[name].compute(lines)
            got = shape(groups)
            assert got.dtypes == wanted.dtypes and rows(got) == rows(wanted), name


def test_exports_and_concentration_scan_the_lines_once(spark, tmp_path):
    sales = spark.read.parquet(str(_lines(spark, tmp_path)))
    groups = suite.kpi_groups(sales)
    groups.collect()
    assert final_plan(groups).count("FileScan parquet") == 1
    facts = suite.concentration_reports(sales, ("category", "shipstate", "sku"))
    facts.collect()
    plan = final_plan(facts)
    assert plan.count("FileScan parquet") == 1 and "SinglePartition" not in plan
    report = suite.export_suite(sales, str(tmp_path / "out"))
    assert report.where(~F.col("success")).isEmpty() and report.count() == 11
    assert {p.name for p in (tmp_path / "out").iterdir()} == set(suite.SUITE)


def _lines(spark, tmp_path):
    sources.sales_orders(spark, SMALL).write.mode("ignore").parquet(str(tmp_path / "lines"))
    return tmp_path / "lines"


def test_concentration_equals_the_report_of_each_key(spark, sales):
    facts = suite.concentration_reports(sales, ("category", "sku"), top_n=7)
    for key in ("category", "sku"):
        groups = sales.groupBy(key).agg(F.sum("amount").alias("total_revenue"))
        wanted = reporting.concentration_report(groups, key, top_n=7)
        assert rows(facts.where(F.col("dimension") == key).drop("dimension"), "rank") == rows(wanted, "rank")


def test_running_shares_over_many_parts(spark, conf, tmp_path):
    conf(spark__sql__shuffle__partitions="9", spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(2)
    values = [(f"k{i}", None if i % 37 == 0 else Decimal(rng.randrange(40))) for i in range(700)] + [(None, Decimal(5))]
    got = op.with_running_share(spark.createDataFrame(values, "k string, v decimal(18,2)"), "k", "v", str(tmp_path / "parts"))
    found = {r["k"]: r for r in got.collect()}
    assert "SinglePartition" not in final_plan(got) and len(found) == 701
    total, running = sum(v for _, v in values if v is not None), Decimal(0)
    for k, v in sorted(values, key=lambda r: (r[1] is None, -(r[1] or 0), r[0] is not None, r[0] or "")):
        running += v or 0
        assert (found[k]["_running"], found[k]["_whole"]) == (running, total)
    none = spark.createDataFrame([], "k string, v decimal(18,2)")
    assert op.with_running_share(none, "k", "v", str(tmp_path / "none")).count() == 0


def test_copies_by_digest(spark, conf):
    wide = "x" * 300
    data = [(1, wide, 0.0), (1, wide, -0.0), (2, None, 1.0), (2, None, 1.0), (None, None, None), (None, None, None), (3, "a", float("nan")), (3, "a", float("nan"))]
    df = spark.createDataFrame(data + [(i, wide + str(i), float(i)) for i in range(10, 400)], "a int, `_digest_1` string, c double")
    got = op.deduplicate_by_digest(df)
    assert got.columns == df.columns and got.count() == df.distinct().count() == 394
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.distinct().collect()))
    # Rows that nothing repeats meet the digests where they are.
    plan = final_plan(got)
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_failing_write_keeps_the_old_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_cleaned(spark.range(3), path)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_cleaned(broken, path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]
    with pytest.raises(Exception, match="lost"):
        sinks.latest_and_archive(broken, str(tmp_path / "r"), "k", "20220101_000000")
    sinks.latest_and_archive(spark.range(2), str(tmp_path / "r"), "k", "20220101_000000")
    with pytest.raises(Exception, match="lost"):
        sinks.latest_and_archive(broken, str(tmp_path / "r"), "k", "20220102_000000")
    assert spark.read.parquet(str(tmp_path / "r/latest/k")).count() == 2
    # A table may be replaced by what is read from it.
    sinks.write_cleaned(spark.read.parquet(path).where("id > 0"), path)
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,)]


def test_what_a_lost_driver_left_is_put_back(spark, tmp_path):
    path = tmp_path / "t"
    sinks.write_cleaned(spark.range(3), str(path))
    path.rename(tmp_path / "_old-t")
    with pytest.raises(Exception):
        sinks.write_cleaned(spark.range(1).select(F.raise_error(F.lit("x")).cast("int").alias("x")), str(path))
    assert spark.read.parquet(str(path)).count() == 3


def test_commands_read_csv_count_unfit_cells_and_take_a_narrative(spark, tmp_path, capsys):
    lines = sources.sales_orders(spark, SMALL)
    late = lines.withColumn("qty", F.when(F.col("qty") == 5, "five").otherwise(F.col("qty").cast("string")))
    sinks.write_cleaned(late, str(tmp_path / "sales"), "csv")
    assert main(["kpi", "--sales", str(tmp_path / "sales"), "--format", "csv", "--out", str(tmp_path / "kpi")], spark) == 0
    fives = lines.where("qty = 5").count()
    assert f"{fives} cells of qty do not fit" in capsys.readouterr().out
    got = sources.read_kpi_typed(spark, str(tmp_path / "kpi"), "cancellation_analysis")
    assert rows(got) == rows(kpi.cancellation_analysis(lines))
    (tmp_path / "story.txt").write_text("A “good” month — " + "x" * 6000)
    assert main(["report", "--kpi", str(tmp_path / "kpi"), "--out", str(tmp_path / "report"), "--narrative", str(tmp_path / "story.txt")], spark) == 0
    text = spark.read.parquet(str(tmp_path / "report/latest/narrative")).first()["text"]
    assert text.startswith('A "good" month - x') and "truncated" in text


def test_infinite_counts_are_shown_as_missing(spark):
    products = spark.createDataFrame([("a", float("inf"))], "sku string, units_sold double")
    assert reporting.top_products_table(products).first()["Units Sold"] is None


def test_every_new_query_has_its_sql():
    from checks.oracle import ORACLE

    assert set(QUERIES) <= set(ORACLE)
