"""Reading files as they come."""

from __future__ import annotations

import pytest

from tallybook import sources
from tallybook.sources.csv import header_names
from tests.conftest import SMALL, rows


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_cells_are_text_or_null(spark, tmp_path):
    path = write(tmp_path / "Sale Report.csv", '﻿a,b\n1,"x, ""y"""\nNA,\n\nnull, NA\n')
    df = sources.read_csv_source(spark, path)
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert sorted(rows(df), key=repr) == sorted(
        [("1", 'x, "y"'), (None, None), (None, " NA")], key=repr
    )


def test_blank_and_repeated_names(spark, tmp_path):
    path = write(tmp_path / "x.csv", "index,Amount,,Amount,\n1,2,3,4,5\n")
    df = sources.read_csv_source(spark, path)
    assert df.columns == ["index", "Amount", "Unnamed: 2", "Amount.1", "Unnamed: 4"]
    assert rows(df) == [("1", "2", "3", "4", "5")]
    assert header_names(["a", "a", "a"]) == ["a", "a.1", "a.2"]


def test_encoding_is_found_per_file(spark, tmp_path):
    folder = tmp_path / "two files"
    folder.mkdir()
    write(folder / "part one.csv", "name\nété\n", "latin-1")
    write(folder / "part%20two.csv", "name\nétoile\n")
    found = sources.file_encodings(spark, str(folder))
    assert sorted(found.values()) == ["ISO-8859-1", "UTF-8"]


def test_latin1_file_beside_a_utf8_one(spark, tmp_path):
    folder = tmp_path / "mixed files"
    folder.mkdir()
    write(folder / "part one.csv", "name,n\nété,1\n", "latin-1")
    write(folder / "part two.csv", "name,n\nétoile ₹,2\n")
    assert rows(sources.read_csv_source(spark, str(folder)), "n") == [("été", "1"), ("étoile ₹", "2")]


def test_line_ends_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n1,"two\nlines"\n2,x\n')
    df = sources.read_csv_source(spark, path, multi_line=True)
    assert rows(df, "a") == [("1", "two\nlines"), ("2", "x")]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "odd"
    folder.mkdir()
    write(folder / "1.csv", "a,b\n1,2\n")
    write(folder / "2.csv", "b,c\n1,2\n")
    with pytest.raises(ValueError, match="differ in their columns"):
        sources.read_csv_source(spark, str(folder))


def test_missing_source_is_skipped(spark, tmp_path):
    here = write(tmp_path / "a.csv", "a\n1\n")
    given = {"gone": str(tmp_path / "gone.csv"), "here": here}
    frames, errors = sources.read_sources(spark, given)
    assert list(frames) == ["here"] and list(errors) == ["gone"]
    assert errors["gone"].startswith("nothing to read")


def test_kpi_gate(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="export the KPIs first"):
        sources.read_kpi_typed(spark, str(tmp_path), "monthly_revenue")
    (tmp_path / "monthly_revenue").mkdir()
    write(tmp_path / "monthly_revenue" / "part.csv", "order_month,monthly_revenue\n")
    with pytest.raises(ValueError, match="monthly_revenue has no rows"):
        sources.read_kpi_files(spark, str(tmp_path), ["monthly_revenue"])
    write(tmp_path / "monthly_revenue" / "part.csv", "order_month,monthly_revenue\n202203,1.5\n")
    read = sources.read_kpi_files(spark, str(tmp_path), ["monthly_revenue"])
    assert rows(read["monthly_revenue"]) == [("202203", 1.5)]


def test_asking_for_fewer_columns_keeps_all_lines(spark):
    whole = sources.sales_orders(spark, SMALL)
    assert whole.columns == list(sources.SALES_COLUMNS)
    lines = whole.count()
    for column in sources.SALES_COLUMNS:
        one = sources.sales_orders(spark, SMALL, [column])
        assert one.count() == lines
        wanted = whole.select(column).groupBy(column).count()
        assert one.groupBy(column).count().exceptAll(wanted).isEmpty()


def test_unknown_column(spark):
    with pytest.raises(ValueError, match="No such column"):
        sources.sales_orders(spark, SMALL, ["colour"])
