"""The stages one after the other, from raw files to report tables."""

from __future__ import annotations

import shutil

import pytest

from checks import fixtures as fx
from tallybook.__main__ import RAW_FILES, main
from tallybook.plans import kpi
from tallybook.plans.cleaning import as_sales_orders, clean_table
from tallybook.sinks import write_cleaned
from tallybook.sources import read_kpi_typed
from tests.conftest import SMALL, rows


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    """Raw files as they would be delivered: two of the five sources are there."""
    root = tmp_path_factory.mktemp("stages")
    (root / "raw").mkdir()
    raw = fx.raw_sales(spark, SMALL)
    write_cleaned(raw.coalesce(1), str(root / "one"), "csv")
    part = next((root / "one").glob("*.csv"))
    shutil.copy(part, root / "raw" / RAW_FILES["amazon_sales"])
    (root / "raw" / RAW_FILES["sale_report"]).write_text("SKU Code,Stock\na-1,5\n,\n", "utf-8-sig")
    return root


def test_stages(spark, work, capsys):
    clean, out, report = work / "clean", work / "kpi", work / "report"
    assert main(["clean", "--raw", str(work / "raw"), "--out", str(clean)], spark) == 1
    assert "nothing to read" in capsys.readouterr().out
    assert rows(spark.read.parquet(f"{clean}/sale_report_cleaned")) == [("A-1", 5)]

    assert main(["load", "--clean", str(clean)], spark) == 1
    assert spark.table("products").columns == ["sku_code", "stock"]
    assert main(["kpi", "--table", "sales_orders", "--out", str(out)], spark) == 0

    wanted = as_sales_orders(clean_table(fx.raw_sales(spark, SMALL), fx.RAW_SALES_TYPES)).cache()
    for name, export in kpi.EXPORTS.items():
        assert rows(read_kpi_typed(spark, str(out), name)) == rows(export.compute(wanted)), name

    assert main(["report", "--kpi", str(out), "--out", str(report)], spark) == 0
    products = spark.read.parquet(f"{report}/latest/top_products")
    assert products.columns == ["Product / SKU", "Revenue (USD)", "Units Sold", "Avg Price (USD)"]
    assert products.count() == 10
    assert spark.read.parquet(f"{report}/archive/state_concentration").count() == 5


def test_report_needs_its_kpis(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        main(["report", "--kpi", str(tmp_path), "--out", str(tmp_path / "out")], spark)
