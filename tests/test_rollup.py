import datetime as dt
import random
from types import SimpleNamespace

from pyspark.sql import functions as F

from bazaarlens.sources.durable import scratch_path
from bazaarlens.sources.tables import STAR_SCHEMAS, open_star
from bazaarlens.streaming import rollup
from tests.conftest import SMALL


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def tables_with(t, orders, items):
    """The tables with other orders and lines."""
    return SimpleNamespace(
        spark=t.spark, orders=orders, delivered_orders=orders.filter("order_status = 'delivered'"),
        order_items=items, products=t.products, translation=t.translation)


def test_increments_and_retries_equal_one_pass(spark):
    t = open_star(spark, SMALL)
    folder, root = scratch_path(spark, "rollup"), scratch_path(spark, "rollup")
    even = F.col("order_id") % 2 == 0
    rollup.write_batch(t, t.orders.filter(even), folder, 0)
    rollup.compact(t, folder, root)
    for _ in range(2):
        rollup.write_batch(t, t.orders.filter(~even), folder, 1)
    want = rollup.partial_rollup(t, t.order_items)
    assert same(rollup.read_rollup(t, folder), want)
    assert same(rollup.read_compacted(t, folder, root), want)  # a batch after the compaction
    rollup.compact(t, folder, root)
    assert same(rollup.read_compacted(t, folder, root), want)


def test_late_and_recalled_deliveries(spark):
    t = open_star(spark, SMALL)
    folder = scratch_path(spark, "rollup")
    late = F.col("order_id") % 3 == 0
    waiting = t.orders.withColumn("order_status", F.when(late, "shipped").otherwise(F.col("order_status")))
    before = tables_with(t, waiting, t.order_items)
    rollup.write_batch(before, before.orders, folder, 0)
    assert same(rollup.read_rollup(before, folder), rollup.partial_rollup(before, before.order_items))
    rollup.write_batch(t, t.orders.filter(late), folder, 1)  # delivered after their lines came
    assert same(rollup.read_rollup(t, folder), rollup.partial_rollup(t, t.order_items))
    rollup.write_batch(before, before.orders.filter(late), folder, 2)  # and taken back
    assert same(rollup.read_rollup(before, folder), rollup.partial_rollup(before, before.order_items))


def test_ids_of_a_loaded_store_are_text(spark):
    t = open_star(spark, SMALL)
    text = lambda df, *names: df.withColumns({n: F.col(n).cast("string") for n in names})
    stored = tables_with(t, text(t.orders, "order_id"), text(t.order_items, "order_id", "seller_id"))
    folder = scratch_path(spark, "rollup")
    rollup.write_batch(stored, stored.orders, folder, 0)
    got = rollup.read_rollup(stored, folder)
    assert got.schema["seller_id"].dataType.simpleString() == "string"
    assert got.count() == rollup.partial_rollup(t, t.order_items).count()


def test_stream_picks_up_where_it_stopped(spark):
    t = open_star(spark, SMALL)
    source, folder, state = (scratch_path(spark, n) for n in ("changes", "rollup", "state"))
    orders = t.raw("orders")

    def run():
        stream = spark.readStream.schema(STAR_SCHEMAS["orders"]).parquet(source)
        changed = stream.select(F.col("o_orderkey").alias("order_id"))
        rollup.start_rollup(lambda: t, changed, folder, state).awaitTermination()

    orders.filter("o_orderkey % 2 = 0").write.mode("append").parquet(source)
    run()
    orders.filter("o_orderkey % 2 = 1").write.mode("append").parquet(source)
    run()
    run()
    assert same(rollup.read_rollup(t, folder), rollup.partial_rollup(t, t.order_items))


def test_batches_of_any_changes_equal_a_recomputation(spark):
    """Orders are inserted, delivered, recalled, re-dated and deleted at random; batches stop halfway and come again."""
    t = open_star(spark, SMALL)
    everything = t.orders.filter("order_id < 400").collect()
    items = t.order_items.filter("order_id < 400")
    rnd, state = random.Random(8), {}
    folder, root = scratch_path(spark, "rollup"), scratch_path(spark, "rollup")
    for batch in range(5):
        named = []
        for row in rnd.sample(everything, 90):
            act, old = rnd.choice(["insert", "deliver", "recall", "move", "delete"]), state.get(row["order_id"], row.asDict())
            if act == "delete":
                state.pop(row["order_id"], None)
            else:
                status = {"deliver": "delivered", "recall": "shipped"}.get(act, old["order_status"])
                placed = old["order_purchase_timestamp"] + dt.timedelta(days=rnd.randint(-40, 40) if act == "move" else 0)
                state[row["order_id"]] = {**old, "order_status": status, "order_purchase_timestamp": placed}
            named.append((row["order_id"],))
        now = tables_with(t, spark.createDataFrame(list(state.values()), t.orders.schema), items)
        changed = spark.createDataFrame(named, "order_id long")
        if batch == 2:  # stopped before it was marked
            half = tables_with(t, now.orders.limit(20), items)
            rollup.write_batch(half, changed, folder, batch, root)
            mark = spark._jvm.org.apache.hadoop.fs.Path(rollup._done(folder, batch))
            mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
        rollup.write_batch(now, changed, folder, batch, root)
        rollup.write_batch(now, changed, folder, batch, root)
        want = rollup.partial_rollup(now, items)
        assert same(rollup.read_rollup(now, folder), want)
        assert same(rollup.read_compacted(now, folder, root), want)
        if batch in (1, 2):
            rollup.compact(now, folder, root)
            assert same(rollup.read_compacted(now, folder, root), want)


def test_only_touched_days_are_written(spark):
    t = open_star(spark, SMALL)
    folder = scratch_path(spark, "rollup")
    rollup.write_batch(t, t.orders, folder, 0)
    one = t.delivered_orders.limit(1).select("order_id", "order_purchase_timestamp").first()
    moved = t.orders.withColumn("order_purchase_timestamp", F.when(
        F.col("order_id") == one["order_id"], F.timestamp_add("DAY", F.lit(3), "order_purchase_timestamp")).otherwise(F.col("order_purchase_timestamp")))
    rollup.write_batch(tables_with(t, moved, t.order_items), t.orders.filter(F.col("order_id") == one["order_id"]), folder, 1)
    days = {r["day"] for r in spark.read.parquet(f"{folder}/changes/batch=1").select("day").collect()}
    first = one["order_purchase_timestamp"].date()
    assert days == {first, first + dt.timedelta(days=3)}
    rollup.write_batch(t, t.orders.filter("order_id % 2 = 0"), folder, 2)
    unchanged = spark.read.parquet(f"{folder}/changes/batch=2")
    assert {r["day"] for r in unchanged.select("day").collect()} <= days


def test_the_ledger_is_read_once_and_dealt_by_order(spark):
    """The last batch of an order counts, whole; the plan has one scan, and no shuffle but by order for the contributions."""
    path = scratch_path(spark, "ledger")
    rows = [(1, 10, 0), (1, 11, 0), (1, 12, 2), (2, 20, 1), (2, 21, 1), (None, 5, 0)]
    spark.createDataFrame(rows, "order_id long, units long, batch long").write.parquet(path)
    last = rollup._last_contributions(spark.read.schema("order_id long, units long, batch long").parquet(path))
    plan = last._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and last.columns == ["order_id", "units", "batch"]
    assert sorted(r["units"] for r in last.collect()) == [12, 20, 21]
    t = open_star(spark, SMALL)
    lines = rollup._contributions(t, t.order_items, rollup._placed(t.delivered_orders))
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [order_id") == 1
