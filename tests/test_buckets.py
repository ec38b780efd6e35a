"""Bucketed facts: equal results, no exchange by order, and no buckets where an order is hot."""

import pytest
from pyspark.sql import functions as F

from bazaarlens.plans import base, checks, delivery
from bazaarlens.sources import buckets
from bazaarlens.sources.tables import open_star
from tests.conftest import SMALL

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def both(spark):
    star = open_star(spark, SMALL)
    made = buckets.BucketedTables(star, 8)
    yield star, made
    made.close()


@pytest.fixture
def shuffled(spark):
    for key, value in NO_BROADCAST.items():
        spark.conf.set(key, value)
    yield
    for key in NO_BROADCAST:
        spark.conf.unset(key)


def exchanges(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    return [line for line in final.split("\n") if "Exchange hashpartitioning(order_id" in line]


REPORTS = [delivery.fan_out_trap, delivery.late_rate_by_state, delivery.reviews_by_outcome, delivery.worst_sellers]


@pytest.mark.parametrize("report", REPORTS)
def test_reports_are_equal(both, report):
    star, made = (sorted(map(str, report(t).collect())) for t in both)
    assert star == made


def test_joins_by_order_have_no_exchange(both, shuffled):
    made = both[1]
    assert set(made.tables) == set(buckets.FACTS)
    for df in (delivery.fan_out_trap(made), base.order_revenue(made), base.order_sellers(made, made.delivered_orders.select("order_id"))):
        assert exchanges(df) == []
    assert exchanges(delivery.fan_out_trap(both[0])) != []


def test_references_by_order_have_no_exchange(both, shuffled):
    frames = both[1].references()
    assert sorted(map(str, checks.references(frames).collect())) == sorted(
        map(str, checks.references({n: both[0].by_name(n) for n in frames}).collect()))
    relations = [r for r in checks.RELATIONS if r.column == "order_id"]
    assert exchanges(checks.references(frames, relations)) == []


class Hot:
    """Lines of which a third belong to one order."""

    def __init__(self, t):
        self.t, self.spark = t, t.spark
        self.order_items = t.order_items.withColumn("order_id", F.when(F.col("seller_id") % 3 == 0, F.lit(1)).otherwise(F.col("order_id")))

    def __getattr__(self, name):
        return getattr(self.t, name)

    def by_name(self, name):
        return self.order_items if name == "order_items" else self.t.by_name(name)


def test_a_hot_order_is_not_bucketed(both):
    hot = Hot(both[0])
    made = buckets.BucketedTables(hot, 16)
    try:
        assert set(made.tables) == set(buckets.FACTS) - {"order_items"}
        assert sorted(map(str, delivery.fan_out_trap(made).collect())) == sorted(map(str, delivery.fan_out_trap(hot).collect()))
    finally:
        made.close()


def test_empty_tables_have_no_largest_bucket(spark):
    assert buckets.largest_bucket(spark.range(0), "id", 8) == 0.0
