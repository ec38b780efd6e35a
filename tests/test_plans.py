"""What the physical plans must and must not contain."""

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from bazaarlens.plans import base
from bazaarlens.sources.tables import open_star
from tests.conftest import SMALL

QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("r")))
def test_reports_have_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for operator in ("NestedLoop", "CartesianProduct", "Python", "ArrowEval"):
        assert operator not in text


def test_delivered_filter_and_columns_reach_the_scan(spark):
    t = open_star(spark, SMALL)
    text = plan(t.delivered_orders.select("order_id"))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_ranges_reach_the_scan(spark):
    assert "Or(And(GreaterThanOrEqual(o_orderdate" in plan(QUERIES["p07_union_of_ranges"](spark, SMALL))


def test_month_filter_skips_partitions(spark):
    text = plan(QUERIES["x02_month_partitions"](spark, SMALL))
    assert "PartitionFilters: [isnotnull(order_month" in text


def test_top_k_and_group_limits(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["t04_top_k"](spark, SMALL))
    assert "WindowGroupLimit" in plan(QUERIES["p13_filter_on_window"](spark, SMALL))
    assert "WindowGroupLimit" in plan(QUERIES["t07_top_1_row_number"](spark, SMALL))


def test_order_totals_reuse_the_join_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["r07_month_over_month"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Items, orders, months of the facts, months of the spine, the sorted series.
    assert text.count("Exchange ") <= 6


class HotOrder:
    """Lines of which half belong to one order."""

    def __init__(self, spark):
        lines = spark.range(400_000)
        order = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
        self.order_items = lines.select(
            order.alias("order_id"), (F.col("id") % 300).alias("seller_id"),
            (F.col("id") % 700).alias("product_id"), (F.col("id") % 90).cast("decimal(10,2)").alias("price"))
        self.delivered_orders = spark.range(5000).select(
            F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.lit("delivered").alias("order_status"))


@pytest.mark.parametrize("build", [
    lambda t: base.sold_items(t, "product_id"),
    lambda t: base.order_sellers(t, t.delivered_orders.select("order_id")),
])
def test_hot_order_is_split(spark, build):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        df = build(HotOrder(spark))
        total = df.agg(F.sum("price" if "price" in df.columns else "revenue")).first()[0]
        df.collect()
        text = plan(df)
    finally:
        for key in small:
            spark.conf.unset(key)
    assert "skew=true" in text
    assert total == sum(i % 90 for i in range(400_000))
