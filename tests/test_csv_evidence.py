"""CSV files as they come: headers, surplus cells, line ends in quotes over many splits, and what one scan tells."""

from __future__ import annotations

import csv
import datetime as dt
import io
import random

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from checks import fixtures as fx
from tallybook import operators as op
from tallybook import sinks, sources
from tallybook.functions import parse_date
from tallybook.functions.dates import parse_timestamp
from tallybook.plans.cleaning import clean_all, clean_table
from tallybook.sources.csv import SURPLUS, read_csv_facts, read_csv_source
from tallybook.sources.csv_facts import LINES, RECORDS, WHOLE, csv_facts
from tests.conftest import SMALL, rows


def write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def test_headers_after_a_blank_line(spark, tmp_path):
    path = write(tmp_path / "in", one="\na,b\n1,2\n", two=" \t\nb,a\n3,4\n", three="\n\n\na,b\n\n5,6\n")
    assert rows(read_csv_source(spark, path).select("a", "b"), "a") == [("1", "2"), ("4", "3"), ("5", "6")]


def test_headers_that_differ_after_a_quoted_line_end(spark, tmp_path):
    path = write(tmp_path / "in", one='"a\nx",b\n1,2\n', two='b,"a\nx"\n3,4\n')
    assert rows(read_csv_source(spark, path).select("`a\nx`", "b"), "b") == [("1", "2"), ("4", "3")]
    with pytest.raises(ValueError, match="differ in their columns"):
        read_csv_source(spark, write(tmp_path / "odd", one='"a\nx",b\n1,2\n', two='"a\ny",b\n3,4\n'))


@pytest.mark.parametrize("row", ["1,2,3", "1,2,,x", "1,2,,,,", '"1,1",2,"a,b"', '1,"2\n2",,x'])
def test_every_surplus_cell_is_seen(spark, tmp_path, row):
    path = write(tmp_path / "in", one=f'a,b\n7,"8,8"\n{row}\n9\n"5 "" 5",6\n')
    with pytest.raises(Exception, match="more cells than its header"):
        read_csv_source(spark, path).collect()
    with pytest.raises(Exception, match="more cells than its header"):
        read_csv_source(spark, path).count()
    marked = read_csv_source(spark, path, mark_surplus=True)
    assert [r[SURPLUS] for r in marked.where(F.col(f"`{SURPLUS}`").isNotNull()).collect()] == [row]
    kept = marked.where(F.col(f"`{SURPLUS}`").isNull()).select("a", "b")
    assert sorted(rows(kept), key=repr) == sorted([("7", "8,8"), ("9", None), ('5 " 5', "6")], key=repr)


def made_records(n, end):
    rng = random.Random(n)
    cells = ["", "x", "two words", "a,b", "li\nne", "\n", "cr\r\nlf", '"', 'say "yes"', "é\n\n,\"\"", "-" * 70, "tab\t"]
    table = [[rng.choice(cells), str(i), rng.choice(cells)] for i in range(n)]
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["first", "number", "li\nst"] if n % 2 else ["first", "number", "last"], *table])
    return out.getvalue(), table


@pytest.mark.parametrize("n, end, size", [(400, "\n", 300), (401, "\r\n", 97), (300, "\n", 5000), (251, "\r\n", 1 << 20)])
def test_line_ends_in_quotes_over_many_splits(spark, conf, tmp_path, n, end, size):
    conf(spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="0")
    text, table = made_records(n, end)
    path = write(tmp_path / "in", one=text, two=text.replace("é", "è"))
    assert {k.quoting for k in csv_facts(spark, path).kinds} == {RECORDS}
    got = read_csv_source(spark, path)
    blank = lambda c: None if c == "" else c
    wanted = [tuple(map(blank, r)) for r in table] + [tuple(blank(c.replace("é", "è")) for c in r) for r in table]
    assert sorted(rows(got), key=repr) == sorted(wanted, key=repr)
    lines = spark.read.option("lineSep", "\n").text(path)
    assert size > 10_000 or lines.rdd.getNumPartitions() > 4


def test_a_record_longer_than_splits(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="200", spark__sql__files__openCostInBytes="0")
    long = "\n".join(f"line {i}" for i in range(300))
    path = write(tmp_path / "in", one=f'a,b\n1,"{long}"\n2,"x\ny"\n3,z\n4,"{long}"\n'.replace("\n", "\n"))
    assert rows(read_csv_source(spark, path), "a") == [("1", long), ("2", "x\ny"), ("3", "z"), ("4", long)]


def test_quotes_that_follow_no_rule_are_read_whole(spark, tmp_path):
    path = write(tmp_path / "in", one='size,n\n5" pipe,1\n6" rod,2\nplain,3\n')
    assert [k.quoting for k in csv_facts(spark, path).kinds] == [WHOLE]
    assert rows(read_csv_source(spark, path), "n") == [('5" pipe', "1"), ('6" rod', "2"), ("plain", "3")]


def test_kinds_side_by_side_are_each_read_once(spark, tmp_path):
    path = write(
        tmp_path / "in", one="n,name\n1,été\n".encode("latin-1"), two="n,name\n2,étoile ₹\n", three='name,n\n"a\nb",3\n',
        four="﻿n,name\n4,x\n", five="n,name\n5,y\n",
    )
    facts = csv_facts(spark, path)
    assert sorted((k.encoding, k.quoting, len(k.files)) for k in facts.kinds) == [
        ("ISO-8859-1", LINES, 1), ("UTF-8", LINES, 3), ("UTF-8", RECORDS, 1)
    ]
    assert rows(read_csv_source(spark, path), "n") == [("1", "été"), ("2", "étoile ₹"), ("3", "a\nb"), ("4", "x"), ("5", "y")]


def test_types_of_the_scan_are_those_of_the_table(spark, tmp_path):
    sinks.write_cleaned(fx.raw_sales(spark, SMALL), str(tmp_path / "raw"), "csv")
    raw, facts = read_csv_facts(spark, str(tmp_path / "raw"))
    assert facts.types == op.infer_types(raw.drop(SURPLUS))
    path = write(
        tmp_path / "odd",
        one="i,d,b,s,none,NA,7\n1,1.5,true,x,,NA,8\n,2,False,,,,9\n",
        two="7,NA,none,s,b,d,i\n1,null,NaN, 5 x,TRUE,-.5e3,99999999999999999999\n",
    )
    raw, facts = read_csv_facts(spark, path)
    assert facts.types == op.infer_types(raw.drop(SURPLUS))
    assert facts.types == {"i": "double", "d": "double", "b": "boolean", "s": "string", "none": "double", "NA": "double", "7": "bigint"}


def test_the_order_of_dates_is_the_columns(spark, tmp_path):
    path = write(tmp_path / "in", one="ship_date,pay_date,due_date,mix_date\n30-04-2022,04/30/2022 10:11,01-02-2022,30-04-2022\n01-05-2022,5/1/22,3-4-2022,04-30-2022\n")
    _, facts = read_csv_facts(spark, path)
    assert facts.day_first == ("ship_date",)
    clean_all(spark, {"s": path}, str(tmp_path / "out"))
    day = dt.date
    assert rows(spark.read.parquet(str(tmp_path / "out/s_cleaned")), "ship_date") == [
        (day(2022, 4, 30), day(2022, 4, 30), day(2022, 1, 2), None), (day(2022, 5, 1), day(2022, 5, 1), day(2022, 3, 4), day(2022, 4, 30))
    ]
    raw = spark.createDataFrame([("30/04/2022",), ("1/5/2022",)], "a_date string")
    assert rows(clean_table(raw, day_first=None), "a_date") == [(day(2022, 4, 30),), (day(2022, 5, 1),)]
    assert sorted(rows(clean_table(raw)), key=repr) == [(None,), (day(2022, 1, 5),)]


@pytest.mark.parametrize(
    "text, day_first, date",
    [
        ("30-04-2022", True, (2022, 4, 30)), ("30/4/22", True, (2022, 4, 30)), ("30-04-2022", False, None),
        ("30-Apr-22", False, (2022, 4, 30)), ("30-Apr-70", True, (1970, 4, 30)), ("04/30/2022 10:11", False, (2022, 4, 30)),
        ("30-04-2022 10:11:12", True, (2022, 4, 30)), ("2022-04-30", True, (2022, 4, 30)), ("31/04/2022", True, None),
    ],
)
def test_day_first_forms(spark, text, day_first, date):
    got = spark.range(1).select(parse_date(F.lit(text), day_first=day_first), parse_timestamp(F.lit(text), day_first)).first()
    assert got[0] == (date and dt.date(*date))
    assert got[1] == (date and dt.datetime(*date, *([10, 11] if "10:11" in text else []), *([12] if text.endswith(":12") else [])))


def test_a_source_is_read_twice_in_all(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "in", one="a_date,n\n30-04-2022,1\n30-04-2022,1\n01-04-2022,x\n")
    read = []
    for kind in ("text", "csv"):
        plain = getattr(DataFrameReader, kind)
        monkeypatch.setattr(DataFrameReader, kind, lambda self, *a, _f=plain, _k=kind, **b: read.append(_k) or _f(self, *a, **b))
    report = clean_all(spark, {"s": path}, str(tmp_path / "out"))
    assert read == ["text", "csv"]
    assert report.select("raw_rows", "clean_rows", "duplicates_removed", "success").first() == (3, 2, 1, True)


def test_surplus_rows_are_counted_and_put_aside(spark, tmp_path):
    path = write(tmp_path / "in", one="a,n\nx,1\nx,1\ny,2,3\ny,2,3\nz,4,,5\n,\n")
    report = clean_all(spark, {"s": path}, str(tmp_path / "out")).first()
    assert (report["raw_rows"], report["clean_rows"], report["duplicates_removed"], report["empty_rows_removed"]) == (6, 1, 1, 1)
    assert report["warnings"] == ["3 rows with more cells than the header"] and report["columns"] == ["a", "n"]
    assert rows(spark.read.parquet(str(tmp_path / "out/s_cleaned"))) == [("x", 1)]
    aside = spark.read.parquet(str(tmp_path / "out/s_cleaned_rejected"))
    assert sorted(r["record"] for r in aside.collect()) == ["y,2,3", "y,2,3", "z,4,,5"]
    typed = clean_all(spark, {"s": path}, str(tmp_path / "typed"), types={"s": {"n": "bigint"}}).first()
    assert typed["warnings"] == report["warnings"] and typed["clean_rows"] == 1


def test_empty_files_and_empty_cells(spark, tmp_path):
    assert read_csv_source(spark, write(tmp_path / "in", one="a,b\n", two="", three="\n\n")).count() == 0
    with pytest.raises(ValueError, match="No columns to read"):
        sources.read_csv_source(spark, write(tmp_path / "none", one="", two=" \n"))
