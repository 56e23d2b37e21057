"""The export run: every KPI to its file, with a report row each."""

from __future__ import annotations

import time
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.plans.kpi import EXPORTS, Kpi
from tallybook.sinks import stage, write_kpi
from tallybook.sinks.files import remove

EXPORT_SCHEMA = (
    "name string, rows bigint, output_path string, elapsed_sec double, success boolean,"
    " error string"
)


def export_kpi(name: str, kpi: Kpi, sales: DataFrame, root: str) -> tuple:
    """Compute and write one KPI. A failure becomes part of the report row."""
    start = time.perf_counter()
    rows, path, success, message = 0, "", False, ""
    try:
        counted = Observation(name)
        result = kpi.compute(sales).observe(counted, F.count("*").alias("rows"))
        path = write_kpi(result, root, name)
        rows, success = counted.get["rows"], True
    except Exception as error:  # one bad KPI must not stop the rest
        message = str(error)
    return name, rows, path, round(time.perf_counter() - start, 3), success, message


def export_all(
    sales: DataFrame,
    root: str,
    kpis: Mapping[str, Kpi] = EXPORTS,
    staged: bool = False,
    at_once: int = 4,
    staging: str | None = None,
) -> DataFrame:
    """Export the KPIs, a few at a time so that their small last stages overlap.

    With ``staged`` the columns they read are written once to the checkpoint folder first; use it
    when ``sales`` is a join, and leave it off when it is already a table. ``staging`` names a shared folder
    to write them to instead, and what is written there is removed at the end.
    """
    spark = sales.sparkSession
    own = f"{staging.rstrip('/')}/sales_orders-{uuid4().hex}" if staging else None
    if own or staged:
        read = {c for kpi in kpis.values() for c in kpi.columns}
        used = sales.select(*[c for c in sales.columns if c in read])
        if own:
            used.write.parquet(own)
            sales = spark.read.parquet(own)
        else:
            sales = stage(used, "sales_orders")

    def run(item: tuple[str, Kpi]) -> tuple:
        return export_kpi(*item, sales, root)

    try:
        with ThreadPoolExecutor(at_once) as pool:
            rows = list(pool.map(inheritable_thread_target(spark)(run), kpis.items()))
    finally:
        if own:
            remove(spark, own)
    return spark.createDataFrame(rows, EXPORT_SCHEMA)


def run_summary(report: DataFrame) -> DataFrame:
    """How many of a run's rows succeeded, and the time they took where it is known."""
    measures = [
        F.count_if("success").alias("succeeded"),
        F.count("*").alias("total"),
    ]
    if "elapsed_sec" in report.columns:
        measures.append(F.coalesce(F.sum("elapsed_sec"), F.lit(0.0)).alias("total_sec"))
    return report.agg(*measures)
