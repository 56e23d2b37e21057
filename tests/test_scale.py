"""Plans and hot keys: what must hold when the tables are a thousand times larger."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tallybook import operators as op
from tallybook.functions import blank_to_null
from tallybook.plans import kpi
from tallybook.plans.cleaning import clean_table
from tallybook.sources import sales_orders
from tests.conftest import SMALL, rows
from tests.plans import final_plan, scans

SHARES = [
    "category_performance",
    "state_performance",
    "fulfillment_performance",
    "cancellation_analysis",
    "customer_segments",
    "concentration_by_state",
]
# These write and read files while the query is built; the plan that is left only reads them.
LAZY = sorted(
    set(kpi.KPIS)
    | {
        "share_of_total",
        "clean_table",
        "cleaning_report",
        "monthly_trend",
        "concentration_report",
        "deduplicate",
        "infer_text_numeric",
        "null_profile",
        "sanitize_text",
        "top_products_table",
        "executive_summary_cleaned",
    }
)


def ran(df):
    df.collect()
    return final_plan(df)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = ran(queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval"):
        assert bad not in plan


@pytest.mark.parametrize("name", [*SHARES, "share_of_total", "monthly_trend"])
def test_shares_read_the_lines_once_and_gather_nothing(spark, name):
    plan = ran(queries()[name](spark, SMALL))
    assert scans(plan, "l_") == 1
    assert "SinglePartition" not in plan


@pytest.mark.parametrize(
    ("name", "tables"),
    [
        ("total_revenue", {"l_", "o_"}),
        ("top_products", {"l_", "o_", "p_"}),
        ("share_of_total", {"l_", "o_", "p_"}),
        ("sales_channel_performance", {"l_", "o_", "c_"}),
        ("state_performance", {"l_", "o_", "c_", "n_"}),
    ],
)
def test_only_the_needed_tables_are_joined(spark, name, tables):
    plan = ran(queries()[name](spark, SMALL))
    assert {t for t in ("l_", "o_", "c_", "n_", "r_", "p_") if scans(plan, t)} == tables


def test_scans_read_only_the_needed_columns(spark):
    plan = ran(queries()["courier_performance"](spark, SMALL))
    read = set(re.findall(r"\b[lo]_[a-z]+(?=:)", " ".join(re.findall(r"ReadSchema: .*", plan))))
    assert {"l_suppkey", "l_shipdate", "l_quantity", "o_totalprice", "o_orderdate"}.isdisjoint(read)


def test_top_k_sorts_no_whole_table(spark):
    plan = ran(queries()["top_cities"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_cleaning_shuffles_once(spark):
    sales = sales_orders(spark, SMALL).where(F.lit(True))
    plan = ran(op.clean_values(op.drop_empty_rows(op.deduplicate(sales.select("sku", "amount")))))
    assert plan.count("Exchange hashpartitioning(sku") == 1
    assert "keys=[sku" in plan


def test_wide_tables_are_planned_fast(spark):
    names = [f"{kind} {i}" for i in range(8) for kind in ("Date", "Sku", "Amount", "City", "Note")]
    raw = spark.range(5).select(*[F.lit("x").alias(n) for n in names])
    cells = raw.select(*[blank_to_null(F.col(f"`{n}`")).alias(n) for n in names])
    start = time.perf_counter()
    clean = clean_table(cells, types={"note_1": "boolean"})
    found = clean.where(F.col("sku_1") == "X").groupBy("city_1").count().where("count > 0")
    assert rows(found) == [("X", 1)]
    assert time.perf_counter() - start < 30


def test_large_sides_are_not_broadcast(spark, conf):
    conf(
        **{
            "spark__sql__autoBroadcastJoinThreshold": "-1",
            "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        }
    )
    wanted = rows(queries()["state_performance"](spark, SMALL))
    df = queries()["state_performance"](spark, SMALL)
    plan = ran(df)
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") >= 3
    assert rows(df) == wanted


def hot(spark, n=60_000):
    """Lines of which a third have one key, as in a hot product."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.lit(1).alias("v"), F.lit("x" * 50).alias("pad"))


def test_a_hot_key_is_split_in_the_join(spark, conf):
    conf(
        **{
            "spark__sql__autoBroadcastJoinThreshold": "-1",
            "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
            "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
            "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
            "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
        }
    )
    lines = hot(spark)
    keys = spark.range(60_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w"))
    df = lines.join(keys, F.col("k") == F.col("key"), "left")
    joined = df.select("k", "w", "pad")
    joined.write.format("noop").mode("overwrite").save()
    counted = df.groupBy("k", "w").agg(F.sum("v").alias("n")).where("k = 7")
    assert rows(counted.select("n")) == [(20_000 + (1 if 7 % 3 else 0),)]
    joined.collect()
    assert "skewed" in final_plan(joined) or "isSkew=true" in final_plan(joined)


def test_hot_copies_merge_before_the_shuffle(spark):
    copies = hot(spark).withColumn("k", F.when(F.col("k") == 7, 7).otherwise(F.col("k")))
    df = op.deduplicate(copies, copies="n")
    counts = {r["k"]: r["n"] for r in df.collect()}
    assert counts[7] == 20_001 and len(counts) == 40_000
    plan = final_plan(df)
    below, above = plan.split("Exchange hashpartitioning")[1], plan.split("Exchange hashpartitioning")[0]
    assert "HashAggregate" in below and "HashAggregate" in above


def test_hot_group_shares(spark):
    groups = hot(spark).groupBy("k").agg(F.sum("v").alias("n"))
    df = op.with_share(groups, "n", "pct")
    got = {r["k"]: r["pct"] for r in df.where("k in (7, 8)").collect()}
    assert got == {7: 33.34, 8: 0.0}
    assert df.count() == 40_000


def test_totals_keep_groups_with_nulls(spark):
    groups = spark.createDataFrame([(None, 1), ("a", None), ("b", 3)], "k string, v int")
    df = op.with_totals(groups, total=F.sum("v"), n=F.count("*"))
    assert sorted(rows(df), key=repr) == [("a", None, 4, 3), ("b", 3, 4, 3), (None, 1, 4, 3)]


def test_totals_of_nothing(spark):
    groups = spark.createDataFrame([], "k string, v int")
    assert rows(op.with_totals(groups, total=F.sum("v"))) == []
