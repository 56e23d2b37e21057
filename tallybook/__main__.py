"""The stages as commands: ``python -m tallybook clean|load|kpi|report`` (or with spark-submit)."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybook import sinks, sources
from tallybook.operators import unfit_measures
from tallybook.plans import cleaning, reporting
from tallybook.plans.export import run_summary
from tallybook.plans.suite import export_suite
from tallybook.session import build_session, input_bytes, size_shuffles, table_bytes

# The raw inputs by source name.
RAW_FILES = {
    "amazon_sales": "Amazon Sale Report.csv",
    "international_sales": "International sale Report.csv",
    "may_sales": "May-2022.csv",
    "pnl": "pnl_report.csv",
    "sale_report": "Sale Report.csv",
}


def clean(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    given = {name: f"{args.raw}/{file}" for name, file in RAW_FILES.items()}
    options = json.loads(args.options) if args.options else None
    return cleaning.clean_all(spark, given, args.out, file_format=args.format, options=options)


def load(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    outcome = sinks.load_all(spark, args.clean)
    rows = [(table, result == "loaded", result) for table, result in outcome.items()]
    return spark.createDataFrame(rows, "name string, success boolean, result string")


def kpi(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The export of all KPIs from one scan, in which cells that do not fit the order table are counted as well."""
    if args.table:
        table = spark.table(args.table)
        if not args.shuffle_bytes:
            size_shuffles(spark, table_bytes(table))
    else:
        table = sources.read_csv_source(spark, args.sales) if args.format == "csv" else spark.read.parquet(args.sales)
    unfit = Observation("unfit")
    renamed = cleaning.sales_names(table)
    counted = table.observe(unfit, *unfit_measures(table, cleaning.SALES_SCHEMA, renamed))
    report = export_suite(cleaning.as_sales_orders(counted), args.out)
    for column, cells in unfit.get.items():
        if cells:
            print(f"{cells} cells of {column} do not fit its type and count as missing")
    return report


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    run_ts = time.strftime("%Y%m%d_%H%M%S")
    kpis = sources.read_kpi_files(spark, args.kpi, reporting.REPORT_KPIS)
    dropped = reporting.dropped_months(kpis["monthly_revenue"]).first()["dropped"]
    if dropped:
        print(f"{dropped} rows without a readable month are left out of the trend")
    tables = reporting.report_tables(kpis)
    if args.narrative:
        text = spark.read.text(args.narrative, wholetext=True).withColumnRenamed("value", "text")
        tables["narrative"] = reporting.narrative_text(text, "text")
    rows = []
    for name, table in tables.items():
        try:
            sinks.latest_and_archive(table, args.out, name, run_ts)
            rows.append((name, True, f"{args.out}/latest/{name}", ""))
        except Exception as error:  # one bad table must not stop the rest
            rows.append((name, False, "", str(error)))
    return spark.createDataFrame(rows, "name string, success boolean, output_path string, error string")


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallybook", description=__doc__)
    parser.add_argument("--master", help="Spark master; by default what the cluster sets")
    parser.add_argument("--shuffle-bytes", type=int, help="size of the input, if its folder does not tell")
    stages = parser.add_subparsers(dest="stage", required=True)

    stage = stages.add_parser("clean", help="raw CSV files to cleaned tables")
    stage.add_argument("--raw", required=True)
    stage.add_argument("--out", required=True)
    stage.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    stage.add_argument("--options", help='options by source as JSON, such as {"may_sales": {"ignore": ["index"]}}')
    stage.set_defaults(run=clean)

    stage = stages.add_parser("load", help="cleaned tables to catalog tables")
    stage.add_argument("--clean", required=True)
    stage.set_defaults(run=load)

    stage = stages.add_parser("kpi", help="a cleaned order table to KPI files")
    source = stage.add_mutually_exclusive_group(required=True)
    source.add_argument("--sales", help="folder of the cleaned order table")
    source.add_argument("--table", help="name of the loaded order table")
    stage.add_argument("--format", choices=("parquet", "csv"), default="parquet", help="of the folder")
    stage.add_argument("--out", required=True)
    stage.set_defaults(run=kpi)

    stage = stages.add_parser("report", help="KPI files to report tables, latest and archived")
    stage.add_argument("--kpi", required=True)
    stage.add_argument("--out", required=True)
    stage.add_argument("--narrative", help="a text file to cut and make plain beside the tables")
    stage.set_defaults(run=report)
    return parser.parse_args(argv)


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    """Run one stage, print its report and summary; 0 when every part succeeded. Shuffles are sized for this stage only."""
    args = parse(argv)
    spark = spark or build_session(master=args.master)
    given = next((p for p in (getattr(args, n, None) for n in ("raw", "clean", "sales", "kpi")) if p), None)
    partitions = "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    try:
        if args.shuffle_bytes or given:
            size_shuffles(spark, args.shuffle_bytes or input_bytes(spark, given))
        outcome = args.run(spark, args)
        outcome.show(truncate=False)
        run_summary(outcome).show()
        return 1 if outcome.where(~F.col("success")).count() else 0
    finally:
        spark.conf.set(partitions, before)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
