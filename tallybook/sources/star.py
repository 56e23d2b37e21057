"""The flat order-line table ``sales_orders``, derived from the star schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALES_COLUMNS = (
    "order_id",
    "order_date",
    "status",
    "fulfilment",
    "sales_channel",
    "shipservicelevel",
    "sku",
    "category",
    "size",
    "courier_status",
    "qty",
    "amount",
    "shipcity",
    "shipstate",
    "shipcountry",
    "b2b",
)

# Which tables beside lineitem a column is made from.
_NEEDS = {
    "order_date": {"orders"},
    "status": {"orders"},
    "sales_channel": {"customer"},
    "shipservicelevel": {"orders"},
    "sku": {"part"},
    "category": {"part"},
    "size": {"part"},
    "qty": {"orders"},
    "amount": {"orders"},
    "shipcity": {"nation"},
    "shipstate": {"nation"},
    "shipcountry": {"region"},
    "b2b": {"customer"},
}
# A table further out is reached through the ones before it.
_THROUGH = {"region": "nation", "nation": "customer", "customer": "orders"}


# Declared, so that reading a table starts no job to find its columns.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in STAR_SCHEMAS:
        reader = reader.schema(STAR_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def sales_orders(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] = SALES_COLUMNS
) -> DataFrame:
    """One row per order line with the asked ``columns``.

    Only the tables those columns need are joined. Every join keeps all lines and meets a unique
    key, so leaving one out changes no row. The geography is joined to the customers and these to
    the orders first: the line table, by far the largest, is then shuffled once for all order
    attributes and once for the product attributes. No side is forced to be broadcast: Spark
    broadcasts a side only when its size is below ``spark.sql.autoBroadcastJoinThreshold``, else it
    sorts and merges, and adaptive execution splits the partitions of a hot key.
    """
    columns = list(columns)
    needed = _tables_for(columns)

    def table(name: str) -> DataFrame:
        return read_table(spark, sf_dir, name)

    sales = table("lineitem")
    if "orders" in needed:
        header = table("orders")
        if "customer" in needed:
            buyer = table("customer")
            if "nation" in needed:
                place = table("nation")
                if "region" in needed:
                    region = table("region")
                    place = place.join(
                        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
                    )
                buyer = buyer.join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            header = header.join(buyer, F.col("o_custkey") == F.col("c_custkey"), "left")
        sales = sales.join(header, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "part" in needed:
        sales = sales.join(table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return sales.select(*[_derive(c).alias(c) for c in columns])


def _tables_for(columns: Iterable[str]) -> set[str]:
    needed = set().union(*(_NEEDS.get(c, set()) for c in columns))
    for outer, inner in _THROUGH.items():
        if outer in needed:
            needed.add(inner)
    return needed


def _derive(column: str) -> Column:
    c = F.col
    match column:
        case "order_id":
            return F.concat(F.lit("ord-"), c("l_orderkey").cast("string"))
        case "order_date":
            return c("o_orderdate").cast("date")
        case "status":
            return (
                F.when(_cancelled(), "Cancelled")
                .when(c("o_orderstatus") == "P", "Pending")
                .when(
                    (c("l_returnflag") == "R") & (c("l_linenumber") == 7), "Shipped - Refunded"
                )
                .when(c("l_returnflag") == "R", "Shipped - Returned to Seller")
                .when(c("l_returnflag") == "A", "Shipped - Delivered to Buyer")
                .otherwise("Shipped")
            )
        case "fulfilment":
            return F.when(c("l_linestatus") == "O", "Amazon").otherwise("Merchant")
        case "sales_channel":
            return F.when(c("c_mktsegment") == "MACHINERY", "Non-Amazon").otherwise("Amazon.in")
        case "shipservicelevel":
            return F.when(
                c("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Expedited"
            ).otherwise("Standard")
        case "sku":
            dash = F.lit("-")
            return F.lower(F.concat("p_brand", dash, "p_type", dash, c("p_size").cast("string")))
        case "category":
            return c("p_type")
        case "size":
            return (
                F.when(c("p_size") <= 10, "S")
                .when(c("p_size") <= 25, "M")
                .when(c("p_size") <= 40, "L")
                .otherwise("XL")
            )
        case "courier_status":
            return F.when(
                c("l_tax") != 0,
                F.when(c("l_returnflag") == "A", "Shipped")
                .when(c("l_returnflag") == "N", "Unshipped")
                .when(c("l_returnflag") == "R", "Cancelled"),
            )
        case "qty":
            return F.when(_cancelled(), F.lit(0)).otherwise(c("l_quantity").cast("bigint"))
        case "amount":
            unpaid = _cancelled() & (c("l_discount") == 0)
            return F.when(~F.coalesce(unpaid, F.lit(False)), c("l_extendedprice")).cast(
                "decimal(18,2)"
            )
        case "shipcity":
            number = (c("c_custkey") % 40).cast("string")
            return F.when(_has_address(), F.concat("n_name", F.lit("/city "), number))
        case "shipstate":
            return F.when(_has_address(), c("n_name"))
        case "shipcountry":
            return c("r_name")
        case "b2b":
            return (c("c_mktsegment") == "AUTOMOBILE") & (c("o_orderpriority") == "1-URGENT")
    raise ValueError(f"No such column in sales_orders: {column}")


def _cancelled() -> Column:
    return (F.col("o_orderstatus") == "P") & (F.col("l_linestatus") == "F")


def _has_address() -> Column:
    return F.col("c_custkey") % 97 != 0
