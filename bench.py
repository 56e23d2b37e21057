"""Time the headline queries: one JSON line with seconds per query and their sum.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. ``load_sales_orders`` joins the
star schema and writes the flat order-line table; every KPI then runs once over that table, as the
engine is meant to be used. Two untimed queries warm the session up. ``export_all`` is one run of
the eleven KPI files, ``export_suite`` the same from one scan. ``clean_all_csv`` reads the raw order table as
CSV, types, cleans and writes it. ``…_from_star`` starts from the star schema instead. ``clean_table`` cleans
the whole raw order table.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import fixtures as fx  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from tallybook.plans.cleaning import clean_all  # noqa: E402
from tallybook.plans.export import export_all  # noqa: E402
from tallybook.plans.kpi import KPIS  # noqa: E402
from tallybook.plans.suite import export_suite  # noqa: E402
from tallybook.session import build_session  # noqa: E402
from tallybook.sinks import write_cleaned  # noqa: E402
from tallybook.sources import sales_orders  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

FROM_STAR = ("total_revenue", "category_performance", "executive_summary")
# Results as large as the tables go to a sink that discards them.
WHOLE_TABLES = (
    "clean_table",
    "deduplicate",
    "detect_and_cast_dates",
    "sanitize_text",
    "share_of_total",
)
SMALL = (
    "cleaning_report",
    "null_profile",
    "monthly_trend",
    "top_products_table",
    "concentration_report",
)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the session's code paths, as a server that answers queries has long done.
    for name in ("category_performance", "executive_summary"):
        QUERIES[name](spark, SF_DIR).collect()
    seconds = {}

    def timed(name: str, run: Callable[[], object]) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    path = fx.scratch(spark, "bench") + "/sales_orders"
    timed("load_sales_orders", lambda: write_cleaned(sales_orders(spark, SF_DIR), path))
    table = spark.read.parquet(path)
    for name, kpi in KPIS.items():
        timed(name, lambda kpi=kpi: kpi.compute(table).collect())
    timed("export_all", lambda: export_all(table, fx.scratch(spark, "export")).collect())
    timed("export_suite", lambda: export_suite(table, fx.scratch(spark, "suite") + "/kpi").collect())
    raw = fx.scratch(spark, "raw") + "/sales"
    write_cleaned(fx.raw_sales(spark, SF_DIR), raw, "csv")
    timed("clean_all_csv", lambda: clean_all(spark, {"sales": raw}, fx.scratch(spark, "clean")).collect())
    for name in FROM_STAR:
        timed(f"{name}_from_star", lambda name=name: QUERIES[name](spark, SF_DIR).collect())
    for name in SMALL:
        timed(name, lambda name=name: QUERIES[name](spark, SF_DIR).collect())
    for name in WHOLE_TABLES:
        discard = lambda name=name: (
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
        timed(name, discard)
    print(
        json.dumps(
            {
                "metric": "sales KPI suite, export, cleaning and reports, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
