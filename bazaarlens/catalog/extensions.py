"""Hierarchies (inventory group H) and recommended extensions (group X)."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from ..functions import money_out, pct
from ..operators.hierarchy import closure, prefix_rollup
from ..operators.joins import grand_total
from ..operators.lattice import grouping_lattice
from ..operators.ordered import value_ranks
from ..operators.topk import share_of_group
from ..plans import customers, delivery
from ..sources import store
from ..sources.durable import cut_lineage, scratch_path
from ..sources.tables import STAR_SCHEMAS
from ..streaming import rollup
from .ordering import NODES
from .registry import query
from .windows import UNITS, units

ROLLED = """
    with leaf as (select zip, state, sum(revenue) as revenue, count(*) as orders from v_order_value group by all)
    select cast(d as bigint) as depth, left(zip, d) as node, round(cast(sum(revenue) as double), 2) as revenue_brl,
           cast(sum(orders) as bigint) as orders, count(distinct zip) as leaf_zips, min(state) as state
    from leaf cross join (values (1), (2), (3), (4), (5)) x(d) group by 1, 2"""


def rolled(t):
    leaves = customers.zip_leaves(t)
    return prefix_rollup(leaves, "zip", 5, revenue=F.sum("revenue"), orders=F.sum("orders"),
                         leaf_zips=F.count_distinct("zip"), state=F.min("state"))


@query("h01_recursive_query", NODES)
def h01(t):
    # Literal recursion over the distinct zips, which are five digits at most.
    zips = cut_lineage(t.customers.select(F.col("customer_zip_code_prefix").alias("zip")).distinct())
    return t.spark.sql(
        """
        WITH RECURSIVE tree (depth, node) AS (
            SELECT DISTINCT CAST(1 AS BIGINT), substring(zip, 1, 1) FROM {zips}
            UNION ALL
            SELECT DISTINCT depth + 1, child
            FROM tree JOIN (
                SELECT CAST(d AS BIGINT) AS level, substring(zip, 1, d) AS parent, substring(zip, 1, d + 1) AS child
                FROM {zips} LATERAL VIEW explode(array(1, 2, 3, 4)) AS d
            ) ON level = depth AND parent = node
            WHERE depth < 5
        )
        SELECT depth, node FROM tree
        """,
        zips=zips,
    )


@query("h02_hierarchical_rollup", ROLLED)
def h02(t):
    return rolled(t).select(F.col("depth").cast("long").alias("depth"), "node", money_out("revenue").alias("revenue_brl"),
                            "orders", "leaf_zips", "state")


@query("h03_share_of_leaf_total", """
    select left(zip, 2) as node, round(100.0 * cast(sum(revenue) as double)
           / (select cast(sum(revenue) as double) from v_order_value), 2) as pct_of_national
    from v_order_value group by 1""")
def h03(t):
    leaves = cut_lineage(customers.zip_leaves(t))
    nodes = prefix_rollup(leaves, "zip", 2, revenue=F.sum("revenue"))
    return nodes.filter(F.col("depth") == 2).select("node", pct("revenue", grand_total(leaves, F.sum("revenue")), 2).alias("pct_of_national"))


@query("h04_branch_filter", """
    select cast(d as bigint) as depth, left(zip, d) as node, count(*) as orders
    from v_order_value cross join (values (1), (2), (3)) x(d)
    where left(zip, d) in ('0', '01') or (d = 3 and zip like '01%') group by 1, 2""")
def h04(t):
    nodes = prefix_rollup(customers.zip_leaves(t), "zip", 3, orders=F.sum("orders"))
    branch = F.col("node").isin("0", "01") | ((F.col("depth") == 3) & F.col("node").startswith("01"))
    return nodes.filter(branch).select(F.col("depth").cast("long").alias("depth"), "node", "orders")


@query("h05_balance_assertion", """
    select count(*) as levels, true as balanced from (values (1), (2), (3), (4), (5)) x(d)
    where (select count(*) from v_order_value) > 0""")
def h05(t):
    balance = customers.rollup_balance(t)
    return balance.agg(F.count("*").alias("levels"), (F.count_distinct("total_revenue_brl") == 1).alias("balanced"))


@query("h06_grouping_sets", ROLLED)
def h06(t):
    leaves = customers.zip_leaves(t).select("zip", "state", "revenue", "orders", *[
        F.substring("zip", 1, d).alias(f"p{d}") for d in range(1, 6)
    ])
    return t.spark.sql(
        """
        SELECT CAST(length(coalesce(p1, p2, p3, p4, p5)) AS BIGINT) AS depth, coalesce(p1, p2, p3, p4, p5) AS node,
               round(CAST(sum(revenue) AS DOUBLE), 2) AS revenue_brl, sum(orders) AS orders,
               count(DISTINCT zip) AS leaf_zips, min(state) AS state
        FROM {leaves}
        GROUP BY GROUPING SETS ((p1), (p2), (p3), (p4), (p5))
        """,
        leaves=leaves,
    )


@query("h06_grouping_lattice", ROLLED)
def h06_lattice(t):
    # Five levels, each from the level below it; a leaf is read once.
    levels = [f"p{d}" for d in range(1, 6)]
    leaves = customers.zip_leaves(t).select("state", "revenue", "orders", *[F.substring("zip", 1, d).alias(c) for d, c in enumerate(levels, 1)])
    measures = {"revenue": ("sum", "revenue"), "orders": ("sum", "orders"), "leaf_zips": ("groups", None), "state": ("min", "state")}
    rows = grouping_lattice(leaves, [levels[:d] for d in range(1, 6)], measures)
    return rows.select(
        (F.col("set") + 1).cast("long").alias("depth"), F.coalesce(*reversed(levels)).alias("node"),
        money_out("revenue").alias("revenue_brl"), F.col("orders"), "leaf_zips", "state")


@query("h07_closure", """
    with recursive edge as (
        select distinct left(customer_zip_code_prefix, d) as parent, left(customer_zip_code_prefix, d + 1) as child
        from v_customers cross join (values (1), (2), (3), (4)) x(d)),
    reach as (
        select parent as ancestor, child as descendant, 1 as distance from edge
        union all
        select r.ancestor, e.child, r.distance + 1 from reach r join edge e on e.parent = r.descendant)
    select distance, count(*) as pairs, count(distinct ancestor) as ancestors, count(distinct descendant) as descendants
    from reach group by 1""")
def h07(t):
    zips = t.customers.select(F.col("customer_zip_code_prefix").alias("zip")).distinct()
    edges = zips.select("zip", F.explode(F.array(*[F.lit(d) for d in range(1, 5)])).alias("d")).select(
        F.left("zip", F.col("d")).alias("parent"), F.left("zip", F.col("d") + 1).alias("child")).distinct()
    return closure(edges).groupBy("distance").agg(
        F.count("*").alias("pairs"), F.count_distinct("ancestor").alias("ancestors"),
        F.count_distinct("descendant").alias("descendants"))


DAILY = """
    select cast(s.bought_at as date) as day, s.seller_id, l.category, round(cast(sum(s.price) as double), 2) as revenue_brl,
           count(*) as units
    from v_sold s join v_labelled l using (product_id) where l.category is not null group by 1, 2, 3"""


def with_orders(t, orders):
    """The tables, with other orders."""
    return SimpleNamespace(
        spark=t.spark, orders=orders, delivered_orders=orders.filter("order_status = 'delivered'"),
        order_items=t.order_items, products=t.products, translation=t.translation)


def _daily_out(df):
    return df.select("day", "seller_id", "category", money_out("revenue").alias("revenue_brl"), "units")


@query("x01_daily_rollup", DAILY)
def x01(t):
    return _daily_out(rollup.partial_rollup(t, t.order_items))


@query("x01_incremental_rollup", DAILY)
def x01_incremental(t):
    # Two increments, the second of them delivered twice and after a compaction.
    folder, root = scratch_path(t.spark, "rollup"), scratch_path(t.spark, "rollup-compact")
    orders = t.orders.select("order_id", (F.month("order_purchase_timestamp") <= 6).alias("early"))
    rollup.write_batch(t, orders.filter("early"), folder, 0)
    rollup.compact(t, folder, root)
    rollup.write_batch(t, orders.filter("not early"), folder, 1)
    rollup.write_batch(t, orders.filter("not early"), folder, 1)
    return _daily_out(rollup.read_compacted(t, folder, root))


@query("x01_retracting_rollup", DAILY)
def x01_retracting(t):
    # Orders arrive with other dates and states, are compacted, and are put right by later batches.
    folder, root = scratch_path(t.spark, "rollup"), scratch_path(t.spark, "rollup-compact")
    key, status, placed = F.col("order_id"), F.col("order_status"), F.col("order_purchase_timestamp")
    early = t.orders.withColumns({
        "order_status": F.when(key % 5 == 0, "delivered").when(key % 5 == 1, "shipped").otherwise(status),
        "order_purchase_timestamp": F.when(key % 3 == 0, F.timestamp_add("DAY", F.lit(40), placed)).otherwise(placed),
    })
    rollup.write_batch(with_orders(t, early), t.orders.select("order_id"), folder, 0)
    rollup.compact(t, folder, root)
    gone = early.filter(key % 7 != 0)
    rollup.write_batch(with_orders(t, gone), t.orders.filter(key % 7 == 0), folder, 1, root)
    rollup.write_batch(t, t.orders.filter((key % 5 <= 1) | (key % 3 == 0) | (key % 7 == 0)), folder, 2, root)
    return _daily_out(rollup.read_compacted(t, folder, root))


@query("x01_streamed_rollup", DAILY)
def x01_streamed(t):
    orders = (
        t.spark.readStream.schema(STAR_SCHEMAS["orders"])
        .option("pathGlobFilter", "orders.parquet").parquet(t.root)
    )
    folder, checkpoint = scratch_path(t.spark, "rollup"), scratch_path(t.spark, "rollup-state")
    changed = orders.select(F.col("o_orderkey").alias("order_id"))
    rollup.start_rollup(lambda: t, changed, folder, checkpoint).awaitTermination()
    return _daily_out(rollup.read_rollup(t, folder))


@query("x02_month_partitions", """
    select strftime(order_purchase_timestamp, '%Y-%m') as order_month, count(*) as orders from v_orders
    where strftime(order_purchase_timestamp, '%Y-%m') between '2000-01' and '2000-08' group by 1""")
def x02(t):
    path = scratch_path(t.spark, "orders-by-month")
    store.write_by_month(t.orders, "order_purchase_timestamp", path)
    months = t.spark.read.schema(t.orders.withColumn("order_month", F.lit("")).schema).parquet(path)
    return months.filter(F.col("order_month").between("2000-01", "2000-08")).groupBy("order_month").agg(
        F.count("*").alias("orders"))


@query("x03_aggregate_before_window", """
    select person, order_id, round(cast(revenue as double), 2) as order_brl,
           round(cast(sum(revenue) over (partition by person) as double), 2) as lifetime_brl
    from v_order_value""")
def x03(t):
    orders = cut_lineage(customers.order_values(t).select(
        F.col("customer_unique_id").alias("person"), "order_id", "revenue"))
    return share_of_group(orders, "person", "revenue", "lifetime").select(
        "person", "order_id", money_out("revenue").alias("order_brl"), money_out("lifetime").alias("lifetime_brl"))


@query("x04_approximate_distinct", """
    select seller_id, count(distinct order_id) as orders, true as within_ten_percent from v_items group by 1""")
def x04(t):
    # The sketch is made of the lines and shuffles one row per seller and task; the
    # exact count, which shuffles every pair, only stands beside it to compare.
    approx = t.order_items.groupBy("seller_id").agg(F.approx_count_distinct("order_id", 0.02).alias("approx"))
    exact = t.order_items.select("seller_id", "order_id").distinct().groupBy("seller_id").agg(F.count("*").alias("orders"))
    error = F.abs(F.col("approx") - F.col("orders")) / F.col("orders")
    return exact.join(approx, "seller_id").select("seller_id", "orders", (error <= 0.1).alias("within_ten_percent"))


@query("x04_mergeable_distinct", """
    select seller_id, count(distinct order_id) as orders, true as within_ten_percent from v_items group by 1""")
def x04_mergeable(t):
    # One sketch per seller and line number, merged without reading the lines again.
    parts = t.order_items.groupBy("seller_id", "order_item_id").agg(F.hll_sketch_agg("order_id", F.lit(14)).alias("sketch"))
    merged = parts.groupBy("seller_id").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx"))
    exact = t.order_items.select("order_id", "seller_id").distinct().groupBy("seller_id").agg(F.count("*").alias("orders"))
    error = F.abs(F.col("approx") - F.col("orders")) / F.col("orders")
    return exact.join(merged, "seller_id").select("seller_id", "orders", (error <= 0.1).alias("within_ten_percent"))


@query("x05_distance_per_zip_pair", """
    select count(*) as pairs, count(km) as mapped, round(min(km), 3) as nearest_km, round(max(km), 3) as farthest_km
    from (select a, b, 2 * 6371 * asin(sqrt(power(sin(radians(c.lat - s.lat) / 2), 2)
                 + cos(radians(s.lat)) * cos(radians(c.lat)) * power(sin(radians(c.lng - s.lng) / 2), 2))) as km
          from (select distinct v.customer_zip_code_prefix as a, w.seller_zip_code_prefix as b
                from v_sold i join v_customers v using (customer_id) join v_sellers w using (seller_id)
                where i.arrived_at is not null) p
          left join v_centroid c on c.zip = p.a left join v_centroid s on s.zip = p.b)""")
def x05(t):
    return delivery.pair_distances(t).agg(
        F.count("*").alias("pairs"), F.count("km").alias("mapped"),
        F.round(F.min("km"), 3).alias("nearest_km"), F.round(F.max("km"), 3).alias("farthest_km"))


@query("x07_cume_dist", UNITS + """
    select product_id, n as units_sold, round(cume_dist() over (order by n), 9) as at_or_below from u""")
def x07(t):
    ranked = value_ranks(units(t), "units_sold", descending=False, rank=None, cume_dist="share")
    return ranked.select("product_id", "units_sold", F.round("share", 9).alias("at_or_below"))


@query("x08_shared_intermediate", """
    select 'people' as level, count(*) as members, round(cast(max(v) as double), 2) as largest_brl
    from (select person, sum(revenue) as v from v_order_value group by 1)
    union all
    select 'states', count(*), round(cast(max(v) as double), 2) from (select state, sum(revenue) as v from v_order_value group by 1)""")
def x08(t):
    # Written once, read by two branches.
    people = cut_lineage(
        customers.order_values(t).join(t.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_unique_id", "customer_state").agg(F.sum("revenue").alias("revenue")))

    def largest(key: str, label: str):
        return people.groupBy(key).agg(F.sum("revenue").alias("v")).agg(
            F.count("*").alias("members"), money_out(F.max("v")).alias("largest_brl")
        ).select(F.lit(label).alias("level"), "members", "largest_brl")

    return largest("customer_unique_id", "people").unionByName(largest("customer_state", "states"))


@query("b02_sorted_lookup", """
    select c.customer_unique_id, c.customer_id from v_customers c where c.customer_unique_id = 42""")
def b02(t):
    path = scratch_path(t.spark, "customers-sorted")
    store.write_sorted(t.customers, "customer_unique_id", path)
    stored = t.spark.read.schema(t.customers.schema).parquet(path)
    return stored.filter(F.col("customer_unique_id") == 42).select("customer_unique_id", "customer_id")
