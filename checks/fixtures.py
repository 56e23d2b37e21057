"""Raw, untidy tables that Spark derives from the given ones, whole."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import dropped_shuffles, input_bytes
from tallybook.sinks.files import CSV_OPTIONS, publish
from tallybook.sources import read_table, sales_orders

# Rows of a raw file: some megabytes of text, as a compressed file is read by one task together with others of its size.
RAW_FILE_ROWS = 1 << 15
# What a scan of all values finds in the raw sales table; given, so that no scan is needed.
RAW_SALES_TYPES = {"qty": "bigint", "b2b": "boolean"}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a round trip: in the cluster's checkpoint folder, or local on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tallybook-{name}-{uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix=f"tallybook-{name}-")


def write_raw(table: DataFrame, path: str, rounds: int = 1) -> None:
    """A raw table as compressed CSV, whole.

    With ``rounds`` it is written share by share, by the hash of the first column, so that a table that is joined
    keeps the shuffles of one share on disk at a time.
    """
    share = F.pmod(F.xxhash64(F.col(f"`{table.columns[0]}`")), F.lit(rounds))

    def write(to: str) -> None:
        for k in range(rounds):
            rows = table.where(share == k) if rounds > 1 else table
            with dropped_shuffles(table.sparkSession):
                rows.write.mode("append").options(**CSV_OPTIONS, compression="gzip", maxRecordsPerFile=RAW_FILE_ROWS).csv(to)

    publish(table.sparkSession, path, write)


def join_rounds(spark: SparkSession, sf_dir: str) -> int:
    """In how many shares the order lines are joined: one below 16 MB of them, at most four."""
    return min(4, 1 + (input_bytes(spark, f"{sf_dir}/lineitem.parquet") >> 24))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales_orders`` as an export would hold it: text cells under untidy names.

    Dates in two formats with some impossible ones, money with signs and separators and negative
    refunds, padded codes, and blank cells beside missing ones.
    """
    sales = sales_orders(spark, sf_dir)
    day = F.dayofmonth("order_date")
    money = F.format_number("amount", 2)
    return sales.select(
        F.col("order_id").alias("Order ID"),
        F.when(day == 31, "13-31-99")
        .when(day % 2 == 0, F.date_format("order_date", "MM-dd-yy"))
        .otherwise(F.date_format("order_date", "yyyy-MM-dd"))
        .alias("Date"),
        F.concat(F.lit(" "), "status", F.lit("\t")).alias("Status"),
        F.col("fulfilment").alias("Fulfilment"),
        F.col("sales_channel").alias("Sales Channel "),
        F.col("shipservicelevel").alias("ship-service-level"),
        F.concat(F.lit("  "), "sku", F.lit(" ")).alias("SKU"),
        F.col("category").alias("Category"),
        F.col("size").alias("Size"),
        F.when(
            F.col("courier_status").isNull() & (F.col("status") == "Pending"), F.lit(" \t ")
        )
        .otherwise(F.col("courier_status"))
        .alias("Courier Status"),
        F.col("qty").cast("string").alias("Qty"),
        F.when(F.col("status") == "Shipped - Refunded", F.concat(F.lit("₹ -"), money))
        .otherwise(F.concat(F.lit(" ₹ "), money))
        .alias("Amount"),
        F.col("shipcity").alias("ship-city"),
        F.col("shipstate").alias("ship-state"),
        F.col("shipcountry").alias("ship-country"),
        F.when(F.col("b2b"), "True").otherwise("False").alias("B2B"),
    )


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in several formats; the last of a month with 31 days is impossible."""
    day, key = F.dayofmonth("o_orderdate"), F.col("o_orderkey")
    return read_table(spark, sf_dir, "orders").select(
        key.alias("order_key"),
        F.when(day == 31, "2022-13-01")
        .when(day % 9 == 0, F.date_format("o_orderdate", "MM-dd-yy"))
        .when(day % 9 == 1, F.date_format("o_orderdate", " yyyy-MM-dd"))
        .when(day % 9 == 2, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(day % 9 == 3, F.date_format("o_orderdate", "MM/dd/yy"))
        .when(day % 9 == 4, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .when(day % 9 == 5, F.date_format("o_orderdate", "dd-MMM-yyyy"))
        .when(day % 9 == 6, F.date_format("o_orderdate", "MMMM d, yyyy"))
        .when(day % 9 == 7, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("order_date"),
    )


def raw_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer balances as money texts; some of them no number at all."""
    balance = F.col("c_acctbal")
    shown = F.concat(F.lit("₹ "), F.format_number(balance, 2))
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("Rs "), shown))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(balance.cast("bigint"), F.lit("d")))
        .when(F.col("c_mktsegment") != "FURNITURE", shown)
        .alias("balance_amount"),
        F.when(F.col("c_mktsegment") != "MACHINERY", balance).alias("plain_price"),
    )


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product names and codes with white space around and odd case."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"),
        F.concat(F.lit(" \t"), F.col("p_brand"), F.lit("-"), "p_type", F.lit("\n")).alias("sku"),
        F.concat(F.lit("  "), F.upper("p_name"), F.lit("/o'"), "p_type", F.lit("2nd_x  ")).alias(
            "category"
        ),
    )


def sparse_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nullable columns of ``sales_orders``, with a number beside."""
    sales = sales_orders(
        spark, sf_dir, ("order_id", "order_date", "courier_status", "shipcity", "amount", "b2b")
    )
    return sales.withColumn("fee", F.when(F.col("courier_status").isNotNull(), F.lit(2.5)))


def ordered_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in columns that prove their order: the day first, the month first, and neither."""
    day, key = F.dayofmonth("o_orderdate"), F.col("o_orderkey")
    date = F.col("o_orderdate")
    return read_table(spark, sf_dir, "orders").select(
        key.alias("order_key"),
        F.when(day % 4 == 0, F.date_format(date, "dd-MM-yyyy"))
        .when(day % 4 == 1, F.date_format(date, " d/M/yyyy"))
        .when(day % 4 == 2, F.date_format(date, "dd-MMM-yy"))
        .otherwise(F.date_format(date, "dd/MM/yyyy HH:mm"))
        .alias("shipped_date"),
        F.when(day % 2 == 0, F.date_format(date, "MM/dd/yyyy HH:mm")).otherwise(F.date_format(date, "MM-dd-yy")).alias("paid_date"),
        F.when(day <= 12, F.date_format(date, "MM-dd-yyyy")).otherwise("soon").alias("due_date"),
    )


def surplus_customers(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Customers as CSV, each seventh with two more cells, the first of them blank; each fifth row twice."""
    customers = read_table(spark, sf_dir, "customer")
    more = F.when(F.col("c_custkey") % 7 == 0, ",,surplus").otherwise("")
    line = F.concat_ws(",", F.col("c_custkey"), F.concat(F.lit("name "), F.col("c_custkey"), more))
    lines = customers.select(F.explode(F.when(F.col("c_custkey") % 5 == 0, F.array(line, line)).otherwise(F.array(line))).alias("customer_key,name"))
    # With another separator the lines are written as they are.
    lines.write.option("header", True).option("sep", "\x01").csv(path)


def nations_under_two_headers(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """Two CSV files whose headers follow a blank line and name the columns in another order."""
    nations = read_table(spark, sf_dir, "nation")
    written = []
    for part, columns in enumerate((("n_nationkey", "n_name"), ("n_name", "n_nationkey"))):
        lines = nations.where(F.col("n_nationkey") % 2 == part).select(F.col("n_nationkey").alias("at"), F.concat_ws(",", *columns).alias("line"))
        head = spark.createDataFrame([(-2, ""), (-1, ",".join(columns))], "at long, line string")
        written.append(f"{path}/{part}")
        head.unionByName(lines.withColumn("at", F.col("at").cast("long"))).coalesce(1).sortWithinPartitions("at").select("line").write.text(written[-1])
    return written
