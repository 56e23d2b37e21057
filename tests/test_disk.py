"""What cleaning leaves and keeps on disk: shuffles, hashes of rows, raw files."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from tallybook import operators as op
from tallybook import sinks
from tallybook.plans import cleaning
from tallybook.session import SHUFFLES_GO
from tests.conftest import SMALL, rows
from tests.plans import final_plan


def _repeated(df, ignore=()):
    return df.select(op.row_hash(df, ignore).alias("hash")).groupBy("hash").count().where("count > 1").select("hash")


def test_rows_without_a_copy_are_not_shuffled(spark):
    nan, none = float("nan"), None
    values = [(1, "a", 0.0, 1), (1, "a", -0.0, 2), (none, "a", nan, 3), (none, "a", nan, 3), ("2", none, none, 4), (none, none, none, none), (none, none, none, none), ("3", "b", 1.5, 9)]
    df = spark.createDataFrame([(k and str(k), *v) for k, *v in values], "k string, t string, x double, i int")
    for ignore in ([], ["i"], ["i", "x"]):
        wanted = op.deduplicate(df, ignore, "n", "filled")
        got = op.deduplicate_known(df, _repeated(df, ignore), (c for c in ignore), "n", "filled")
        assert got.dtypes == wanted.dtypes
        assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(wanted))) and wanted.count() < 8
    # A hash that others have by chance costs work and no row.
    every = df.select(op.row_hash(df).alias("hash")).distinct()
    assert sorted(map(repr, rows(op.deduplicate_known(df, every)))) == sorted(map(repr, rows(op.deduplicate(df))))
    wide = spark.range(1000).select("id", F.lit("x" * 50).alias("t"))
    known = op.deduplicate_known(wide, spark.createDataFrame([], "hash bigint"), copies="n")
    assert known.where("n = 1").count() == 1000
    assert "LeftAnti, BuildRight" in final_plan(known)


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_large_sources_are_cleaned_as_small_ones(spark, tmp_path, monkeypatch, most):
    path = tmp_path / "in"
    path.mkdir()
    (path / "one.csv").write_text("a_date,n,note\n2022-04-30,1,x\n2022-04-30, 1,x\n2022-05-01,2,\n,,\n,,\n,,\n2022-05-01,3,y,z\n2022-05-01,3,y,z\n")
    given, reports = {"s": str(path)}, []
    declared = {"s": {"n": "bigint", "note": "bigint"}}
    for name, size in (("small", 1 << 40), ("large", 0)):
        monkeypatch.setattr(cleaning, "SIFTED_BYTES", size)
        monkeypatch.setattr(cleaning, "MOST_REPEATED", most)
        for how, types in (("inferred", None), ("declared", declared)):
            out = f"{tmp_path}/{name}-{how}"
            report = cleaning.clean_all(spark, given, out, types).collect()
            reports.append((how, repr(report), sorted(map(repr, rows(spark.read.parquet(f"{out}/s_cleaned"))))))
            assert report[0]["success"], report
            assert {p.name for p in (tmp_path / f"{name}-{how}").iterdir()} == {"s_cleaned", "s_cleaned_rejected"}
    assert reports[:2] == reports[2:]
    assert reports[0][2] and "raw_rows=8" in reports[0][1]


def _shuffles(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {b for b in str(manager.getAllBlocks().mkString(" ")).split() if b.startswith("shuffle_")}


def test_what_is_written_leaves_no_shuffle_behind(spark, tmp_path):
    before, set_before = _shuffles(spark), spark.conf.get(SHUFFLES_GO)
    table = spark.range(5000).repartition(7, "id").groupBy((F.col("id") % 11).alias("k")).count()
    sinks.write_cleaned(table, str(tmp_path / "out"))
    for _ in range(40):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.25)
    assert not _shuffles(spark) - before
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("count")).first()[0] == 5000
    assert table.count() == 11 and spark.conf.get(SHUFFLES_GO) == set_before


def test_raw_files_hold_the_whole_table_in_any_number_of_rounds(spark, tmp_path):
    raw = fx.raw_sales(spark, SMALL).select("Order ID", "Amount").limit(3000)
    raw = raw.unionByName(raw.limit(3).withColumn("Order ID", F.lit(None).cast("string"))).cache()
    for rounds in (1, 3):
        path = str(tmp_path / str(rounds))
        fx.write_raw(raw, path, rounds)
        assert all(p.suffix == ".gz" for p in (tmp_path / str(rounds)).glob("part-*"))
        back = spark.read.options(**sinks.files.CSV_OPTIONS).csv(path)
        assert sorted(rows(back), key=repr) == sorted(rows(raw), key=repr)
