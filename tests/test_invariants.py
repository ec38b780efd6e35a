"""Properties the reports must keep whatever the data."""

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators.hierarchy import closure
from bazaarlens.operators.joins import repeated_sum, small_side
from bazaarlens.plans import customers, delivery, ranking, running


def test_rollup_balances(tables):
    balance = customers.rollup_balance(tables)
    customers.assert_balanced(balance)
    with pytest.raises(ValueError):
        customers.assert_balanced(balance.withColumn("total_revenue_brl", F.col("depth").cast("double")))


def test_fan_out_only_inflates(tables):
    rows = {r["method"].split(":")[0]: r for r in delivery.fan_out_trap(tables).collect()}
    assert rows["WRONG"]["payment_total_brl"] > rows["CORRECT"]["payment_total_brl"]


def test_repeated_sums_equal_the_join(spark):
    left = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "k int, a int")
    right = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (3, 9)], "k int, b int")
    joined = left.join(right, "k").agg(F.sum("a"), F.sum("b")).first()
    l = left.groupBy("k").agg(F.count("*").alias("m"), F.sum("a").alias("a"))
    r = right.groupBy("k").agg(F.count("*").alias("n"), F.sum("b").alias("b"))
    got = l.join(r, "k").agg(repeated_sum("a", "n"), repeated_sum("b", "m")).first()
    assert tuple(int(x) for x in got) == tuple(joined)


def test_bands_sum_to_the_dated_orders(tables):
    dated = delivery.late_by_comparison(tables).first()["orders"]
    bands = delivery.lateness_by_distance(tables).agg(F.sum("orders")).first()[0]
    outcomes = delivery.reviews_by_outcome(tables).agg(F.sum("orders")).first()[0]
    with_items = tables.order_items.select("order_id").distinct().join(
        delivery.base.dated_deliveries(tables), "order_id", "left_semi").count()
    assert outcomes == dated and bands == with_items


def test_deciles_differ_by_at_most_one(tables):
    sizes = [r["sellers"] for r in ranking.seller_deciles(tables).collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_last_running_total_is_the_partition_total(tables):
    rows = running.repeat_customer_spend(tables)
    last = rows.groupBy("customer").agg(F.max("cumulative_brl").alias("c"), F.round(F.sum("order_brl"), 2).alias("s"))
    assert all(abs(r["c"] - r["s"]) < 0.01 for r in last.collect())


def test_reported_day_counts(tables):
    """Counts observed on the test data."""
    row = delivery.late_by_comparison(tables).first()
    assert (row["late_by_timestamp"], row["late_by_date"]) == (1647, 1526)


def test_closure_stops_on_cycles_and_keeps_the_shortest(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (1, 3)], "parent int, child int")
    pairs = {(r["ancestor"], r["descendant"]): r["distance"] for r in closure(edges).collect()}
    assert pairs[(1, 3)] == 1 and pairs[(1, 4)] == 2 and pairs[(2, 2)] == 3 and len(pairs) == 12


def test_small_side_checks_the_size(spark):
    from pyspark.sql import DataFrame

    def hinted(df: DataFrame) -> bool:
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(small_side(spark.range(10), rows=10))
    assert not hinted(small_side(spark.range(11), rows=10))


def test_closure_follows_a_long_chain_to_its_end(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(25)], "parent long, child long")
    assert closure(edges).count() == 25 * 26 // 2


def test_scratch_paths_are_removed(spark):
    import os

    from bazaarlens.sources import durable

    before, durable._made[:] = list(durable._made), []
    path = durable.scratch_path(spark, "gone")
    spark.range(5).write.parquet(path)
    assert os.path.isdir(path)
    durable.release(spark)
    assert not os.path.exists(path) and not durable._made
    durable._made[:] = before


def test_tasks_read_small_pieces_of_a_shuffle(spark):
    """A quarter of Spark's default, unless the caller chose a size."""
    from bazaarlens.session import configure

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert configure(spark).conf.get(key) == "16m"
    spark.conf.set(key, "1m")
    try:
        assert configure(spark).conf.get(key) == "1m"
    finally:
        spark.conf.set(key, "16m")
