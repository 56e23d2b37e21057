"""One query per operator. Each reads whole tables in ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from tallybook import operators as op
from tallybook import sinks, sources
from tallybook.functions import blank_to_null, sanitize, share_pct, strip, title_case, truncate, upper_code
from tallybook.plans import cleaning, kpi, reporting, suite
from tallybook.plans.export import export_all, run_summary
from tallybook.plans.suite import concentration_reports

Query = Callable[[SparkSession, str], DataFrame]


def _kpi(name: str) -> Query:
    chosen = kpi.KPIS[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return chosen.compute(sources.sales_orders(spark, sf_dir, chosen.columns))

    return query


def _cleaned_kpi(name: str) -> Query:
    """The KPI over the raw table after the whole cleaning stage."""
    chosen = kpi.KPIS[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return chosen.compute(cleaning.as_sales_orders(clean_table(spark, sf_dir)))

    return query


# Sources and sinks


def read_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.scratch(spark, "csv") + "/raw sales"
    sinks.write_cleaned(fx.raw_sales(spark, sf_dir), path, "csv")
    return op.standardize_columns(sources.read_csv_source(spark, path))


def encoding_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.scratch(spark, "latin1") + "/parts"
    parts = sources.read_table(spark, sf_dir, "part")
    accented = parts.select("p_partkey", F.concat(F.lit("café "), "p_name").alias("p_name"))
    writer = accented.write.option("header", True).option("encoding", "ISO-8859-1")
    writer.csv(path)
    read = sources.read_csv_source(spark, path)
    return read.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name")


def na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = sources.read_table(spark, sf_dir, "customer")
    token = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "NA")
        .when(F.col("c_mktsegment") == "BUILDING", "#N/A")
        .when(F.col("c_mktsegment") == "FURNITURE", "")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", " NA")
        .otherwise(F.col("c_name"))
    )
    return customers.select("c_custkey", blank_to_null(token).alias("value"))


def missing_source_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.scratch(spark, "skip")
    customers = sources.read_table(spark, sf_dir, "customer")
    sinks.write_cleaned(customers, f"{path}/customers", "csv")
    given = {"absent": f"{path}/absent", "customers": f"{path}/customers"}
    report = cleaning.clean_all(spark, given, f"{path}/clean")
    return report.select("name", "raw_rows", "clean_rows", "success")


def kpi_input_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.require_rows(_kpi("monthly_revenue")(spark, sf_dir), "monthly_revenue")


def write_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.scratch(spark, "cleaned") + "/sales"
    sinks.write_cleaned(clean_table(spark, sf_dir), path)
    return spark.read.parquet(path)


def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table as a named view, read with SQL text as from a database."""
    sinks.load_table(clean_table(spark, sf_dir), "loaded_sales", as_view=True)
    return spark.sql(
        "SELECT shipcountry, COUNT(*) AS line_count, SUM(qty) AS units_sold"
        " FROM loaded_sales GROUP BY shipcountry ORDER BY shipcountry"
    )


def _exported(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = fx.scratch(spark, "kpi")
    sinks.write_kpi(_kpi(name)(spark, sf_dir), path, name)
    return sources.read_kpi_typed(spark, path, name)


def export_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, "state_performance")


def read_kpi_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, "monthly_revenue")


def _export_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.scratch(spark, "export")
    return export_all(sources.sales_orders(spark, sf_dir), f"{path}/kpi", staging=f"{path}/staged")


def export_all_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export_run(spark, sf_dir).select("name", "rows", "success")


def latest_and_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fx.scratch(spark, "archive")
    result = _kpi("category_performance")(spark, sf_dir)
    for run_ts in ("20260101_000000", "20260102_000000"):
        sinks.latest_and_archive(result, root, "category_performance", run_ts)
    latest = spark.read.parquet(f"{root}/latest/category_performance")
    archive = spark.read.option("inferSchema", False).parquet(
        f"{root}/archive/category_performance"
    )
    return archive.withColumn("run_ts", F.col("run_ts").cast("string")).unionByName(
        latest.withColumn("run_ts", F.lit("latest"))
    )


# Cleaning


def standardize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = sources.read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    untidy = parts.toDF(" Part-Key X ", "Unnamed: 22", "A-B")
    return op.standardize_columns(untidy.withColumn("AB", F.col("`A-B`") + 1))


def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sources.read_table(spark, sf_dir, "lineitem")
    return op.deduplicate(lines.select("l_orderkey", "l_linenumber"))


def deduplicate_ignoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sources.read_table(spark, sf_dir, "lineitem")
    return op.deduplicate(
        lines.select("l_orderkey", "l_linenumber", "l_partkey"), ignore=["l_partkey"]
    )


def drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sparse = fx.sparse_sales(spark, sf_dir)
    return op.drop_empty_rows(sparse.select("courier_status", "shipcity", "fee"))


def count_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.count_removed(fx.sparse_sales(spark, sf_dir).select("courier_status", "shipcity"))


def infer_text_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.type_evidence(op.standardize_columns(fx.raw_sales(spark, sf_dir)))


def detect_and_cast_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.detect_and_cast_dates(fx.raw_dates(spark, sf_dir))


def unparsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unparsed_dates(fx.raw_dates(spark, sf_dir), ["order_date"])


def apply_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.apply_schema(
        fx.raw_dates(spark, sf_dir),
        "order_no int, order_date date, order_text string",
        {"order_no": "order_key", "order_text": "order_key"},
    )


def fill_nulls_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fill_nulls_text(fx.sparse_sales(spark, sf_dir).drop("b2b"))


def fill_nulls_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = op.fill_nulls_numeric(fx.sparse_sales(spark, sf_dir))
    return filled.select("order_id", "shipcity", F.col("amount").cast("double"), "fee")


def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.raw_parts(spark, sf_dir)
    return parts.select("part_key", strip(F.col("category")).alias("category"))


def clean_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_values(fx.raw_balances(spark, sf_dir))


def clean_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_parts(spark, sf_dir).select("part_key", upper_code(F.col("sku")).alias("sku"))


def title_case_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.raw_parts(spark, sf_dir)
    return parts.select("part_key", title_case(strip(F.col("category"))).alias("category"))


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_table(fx.raw_sales(spark, sf_dir), fx.RAW_SALES_TYPES)


def clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables written as compressed CSV, then read, typed, cleaned and written in one run each."""
    path = fx.scratch(spark, "clean")
    raw = {
        "sales": fx.raw_sales(spark, sf_dir),
        "balances": fx.raw_balances(spark, sf_dir),
        "dates": fx.raw_dates(spark, sf_dir),
    }
    for name, table in raw.items():
        fx.write_raw(table, f"{path}/{name}", fx.join_rounds(spark, sf_dir) if name == "sales" else 1)
    given = {name: f"{path}/{name}" for name in raw}
    return _flat_report(cleaning.clean_all(spark, given, f"{path}/clean"))


def stringify_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = sources.read_table(spark, sf_dir, "embeddings")
    return op.stringify_objects(
        embeddings.select("vec_id", F.transform("embedding", lambda v: v > 0).alias("signs"))
    )


# Shares, reports, metrics


def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share over a key with many values: every product."""
    sales = sources.sales_orders(spark, sf_dir, ("sku", "qty"))
    groups = sales.groupBy("sku").agg(F.sum("qty").alias("units_sold"))
    return op.with_share(groups, "units_sold", "unit_share_pct")


def date_parse_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sources.read_table(spark, sf_dir, "orders")
    raw = orders.withColumn("date", F.date_format("o_orderdate", "MM-dd-yy"))
    return kpi.date_parse_preview(raw, "date", "o_orderkey")


def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.monthly_trend(_kpi("monthly_revenue")(spark, sf_dir))


def category_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.category_ranking(_kpi("category_performance")(spark, sf_dir))


def top_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.top_states(_kpi("state_performance")(spark, sf_dir))


def top_products_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.top_products_table(_kpi("top_products")(spark, sf_dir))


def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = sources.read_table(spark, sf_dir, "documents")
    return documents.select("doc_id", sanitize(F.col("text")).alias("text"))


def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = sources.read_table(spark, sf_dir, "documents")
    return documents.select("doc_id", truncate(F.col("text")).alias("text"))


def narrative_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = sources.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return reporting.narrative_text(documents, "text")


def concentration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("category", "shipstate", "sku", "amount")
    return concentration_reports(sources.sales_orders(spark, sf_dir, columns), ("category", "shipstate", "sku"))


def cumulative_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product's share of the revenue, and the share of all products down to it."""
    sales = sources.sales_orders(spark, sf_dir, ("sku", "amount"))
    groups = sales.groupBy("sku").agg(F.sum("amount").alias("revenue"))
    summed = op.with_running_share(groups, "sku", "revenue", fx.scratch(spark, "running") + "/parts")
    return summed.select(
        "sku",
        F.col("revenue").cast("double").alias("revenue"),
        share_pct(F.col("revenue"), F.col("_whole")).alias("share_pct"),
        share_pct(F.col("_running"), F.col("_whole")).alias("cumulative_share_pct"),
    )


def kpi_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group of every exported KPI, from one scan."""
    groups = suite.kpi_groups(sources.sales_orders(spark, sf_dir, suite.COLUMNS))
    member = F.coalesce(*(F.when(F.col("key") == k, F.col(k).cast("string")) for k in suite.KEYS))
    return groups.select(
        "key", member.alias("member"), "total_orders", F.col("lines").alias("line_count"),
        F.col("units").alias("units_sold"), F.col("revenue").cast("double").alias("revenue"),
    )


def export_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All exports from one scan, read back from their files; what each holds is told by its sums."""
    path = fx.scratch(spark, "suite") + "/kpi"
    report = suite.export_suite(sources.sales_orders(spark, sf_dir, suite.COLUMNS), path)
    parts = []
    for name in suite.SUITE:
        read = sources.read_kpi_typed(spark, path, name)
        money = next(c for c in ("total_revenue", "monthly_revenue", "revenue") if c in read.columns)
        parts.append(read.agg(F.lit(name).alias("name"), F.round(F.sum(money), 2).alias("revenue")))
    return report.select("name", "rows", "success").join(reduce(DataFrame.unionByName, parts), "name")


def read_csv_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as CSV, whose texts hold line ends and quotes, read split by split."""
    path = fx.scratch(spark, "quoted") + "/documents"
    documents = sources.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    sinks.write_cleaned(documents, path, "csv")
    return sources.read_csv_source(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def read_csv_two_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files whose columns stand in another order, each under a blank line."""
    paths = fx.nations_under_two_headers(spark, sf_dir, fx.scratch(spark, "headers") + "/nations")
    return sources.read_csv_source(spark, paths)


def clean_surplus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning report of a source with rows that have more cells than their header."""
    path = fx.scratch(spark, "surplus")
    fx.surplus_customers(spark, sf_dir, f"{path}/customers")
    return _flat_report(cleaning.clean_all(spark, {"customers": f"{path}/customers"}, f"{path}/clean"))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that the cleaning run put aside."""
    path = fx.scratch(spark, "rejected")
    fx.surplus_customers(spark, sf_dir, f"{path}/customers")
    cleaning.clean_all(spark, {"customers": f"{path}/customers"}, f"{path}/clean")
    return spark.read.parquet(f"{path}/clean/customers_cleaned_rejected")


def dates_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates whose columns prove whether the day or the month stands first."""
    raw = fx.ordered_dates(spark, sf_dir)
    return op.detect_and_cast_dates(raw, op.day_first_columns(raw, op.date_columns(raw)))


def clean_ordered_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same dates through CSV and the whole cleaning run."""
    path = fx.scratch(spark, "ordered")
    sinks.write_cleaned(fx.ordered_dates(spark, sf_dir), f"{path}/dates", "csv")
    cleaning.clean_all(spark, {"dates": f"{path}/dates"}, f"{path}/clean")
    return spark.read.parquet(f"{path}/clean/dates_cleaned")


def clean_declared_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types are applied after copies and empty rows go, and cells that do not fit are counted."""
    customers = sources.read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    kind = F.when(key % 3 == 0, F.concat(key, F.lit("x"))).when(key % 3 == 1, (key % 50).cast("string"))
    raw = customers.select(kind.alias("Stock"), F.when(key % 6 != 2, F.col("c_mktsegment")).alias("Segment"))
    return _flat_report(cleaning.cleaning_report("stock", raw, {"stock": "bigint"}))


def deduplicate_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines without their numbers, which repeat, and with all their columns."""
    lines = sources.read_table(spark, sf_dir, "lineitem")
    return op.deduplicate_by_digest(lines.select("l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_tax"))


def equal_row_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of groups that look alike: each keeps its own."""
    lines = sources.read_table(spark, sf_dir, "lineitem")
    groups = lines.groupBy("l_orderkey").agg(F.count("*").alias("line_count")).select("line_count")
    return op.with_share(groups, "line_count", "share_pct")


def dropped_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many days without a readable month a trend leaves out."""
    orders = sources.read_table(spark, sf_dir, "orders")
    month = F.when(F.dayofmonth("o_orderdate") % 5 == 0, F.lit("soon")).otherwise(F.date_format("o_orderdate", "MM/yyyy"))
    return reporting.dropped_months(orders.select(month.alias("order_month")))


def _flat_report(report: DataFrame) -> DataFrame:
    fills = F.array_sort(F.map_entries("null_fills"))
    shown = F.transform(fills, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return report.select(
        "name",
        "raw_rows",
        "clean_rows",
        "duplicates_removed",
        "empty_rows_removed",
        F.concat_ws(",", shown).alias("null_fills"),
        F.concat_ws(",", "columns").alias("columns"),
        F.concat_ws(",", "warnings").alias("warnings"),
        "success",
    )


def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_sales(spark, sf_dir)
    return _flat_report(cleaning.cleaning_report("sales", raw, fx.RAW_SALES_TYPES))


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.null_profile(sources.sales_orders(spark, sf_dir))


def export_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export_run(spark, sf_dir).select(
        "name", "rows", (F.col("elapsed_sec") > 0).alias("timed"), "success", "error"
    )


def run_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(_export_run(spark, sf_dir)).select("succeeded", "total")


QUERIES: dict[str, Query] = {
    **{name: _kpi(name) for name in kpi.KPIS},
    "executive_summary_cleaned": _cleaned_kpi("executive_summary"),
    "category_performance_cleaned": _cleaned_kpi("category_performance"),
    "monthly_revenue_cleaned": _cleaned_kpi("monthly_revenue"),
    "date_parse_preview": date_parse_preview,
    "share_of_total": share_of_total,
    "read_csv_source": read_csv_source,
    "encoding_fallback": encoding_fallback,
    "na_tokens": na_tokens,
    "missing_source_skip": missing_source_skip,
    "kpi_input_gate": kpi_input_gate,
    "write_cleaned": write_cleaned,
    "load_table": load_table,
    "export_kpi": export_kpi,
    "export_all": export_all_kpis,
    "latest_and_archive": latest_and_archive,
    "read_kpi_typed": read_kpi_typed,
    "standardize_columns": standardize_columns,
    "deduplicate": deduplicate,
    "deduplicate_ignoring": deduplicate_ignoring,
    "drop_empty_rows": drop_empty_rows,
    "count_removed": count_removed,
    "infer_text_numeric": infer_text_numeric,
    "detect_and_cast_dates": detect_and_cast_dates,
    "unparsed_dates": unparsed_dates,
    "apply_schema": apply_schema,
    "fill_nulls_text": fill_nulls_text,
    "fill_nulls_numeric": fill_nulls_numeric,
    "strip_text": strip_text,
    "clean_money": clean_money,
    "clean_sku": clean_sku,
    "title_case": title_case_query,
    "clean_table": clean_table,
    "clean_all": clean_all,
    "stringify_objects": stringify_objects,
    "monthly_trend": monthly_trend,
    "category_ranking": category_ranking,
    "top_states": top_states,
    "top_products_table": top_products_table,
    "sanitize_text": sanitize_text,
    "truncate_text": truncate_text,
    "narrative_text": narrative_text,
    "concentration_report": concentration_report,
    "cumulative_shares": cumulative_shares,
    "kpi_groups": kpi_groups,
    "export_suite": export_suite,
    "read_csv_quoted_lines": read_csv_quoted_lines,
    "read_csv_two_headers": read_csv_two_headers,
    "clean_surplus_rows": clean_surplus_rows,
    "rejected_rows": rejected_rows,
    "dates_by_column": dates_by_column,
    "clean_ordered_dates": clean_ordered_dates,
    "clean_declared_types": clean_declared_types,
    "deduplicate_by_digest": deduplicate_by_digest,
    "equal_row_shares": equal_row_shares,
    "dropped_months": dropped_months,
    "cleaning_report": cleaning_report,
    "null_profile": null_profile,
    "export_report": export_report,
    "run_summary": run_summary_query,
}
