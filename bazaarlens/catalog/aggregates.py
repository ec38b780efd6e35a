"""Aggregations (inventory group A)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import mean, money_out, month_of, pct, quarter_of, quotient
from ..operators.bitmaps import count_distinct, stored_bitmaps
from ..operators.ordered import ntile
from ..plans import base, customers
from ..sources.durable import cut_lineage
from .registry import query
from .reports import DATED


@query("a01_exact_sum", "select seller_id, round(cast(sum(price) as double), 2) as revenue_brl from v_items group by 1")
def a01(t):
    return t.order_items.groupBy("seller_id").agg(money_out(F.sum("price")).alias("revenue_brl"))


@query("a02_count_rows", "select seller_id, count(*) as lines from v_items group by 1")
def a02(t):
    return t.order_items.groupBy("seller_id").agg(F.count("*").alias("lines"))


@query("a03_count_non_null", """
    select order_status, count(order_delivered_customer_date) as dated,
           count(*) - count(order_delivered_customer_date) as undated from v_orders group by 1""")
def a03(t):
    dated = F.count("order_delivered_customer_date")
    return t.orders.groupBy("order_status").agg(dated.alias("dated"), (F.count("*") - dated).alias("undated"))


@query("a04_count_distinct", """
    select seller_id, count(distinct order_id) as orders, count(distinct product_id) as products from v_items group by 1""")
def a04(t):
    # Each distinct pair is kept once before it is counted, so no task holds a
    # seller's whole set of orders.
    return t.order_items.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders"), F.count_distinct("product_id").alias("products")
    )


@query("a05_average", """
    select seller_id, round(cast(sum(price) as double) / count(*), 2) as avg_price_brl from v_items group by 1""")
def a05(t):
    return t.order_items.groupBy("seller_id").agg(mean("price", 2).alias("avg_price_brl"))


@query("a06_min_max", """
    select customer_unique_id as person, min(order_purchase_timestamp) as first_order, max(order_purchase_timestamp) as last_order,
           min(order_status) as first_status, max(order_id) as last_id
    from v_orders join v_customers using (customer_id) group by 1""")
def a06(t):
    placed = "order_purchase_timestamp"
    return t.orders.join(t.customers, "customer_id").groupBy(F.col("customer_unique_id").alias("person")).agg(
        F.min(placed).alias("first_order"), F.max(placed).alias("last_order"),
        F.min("order_status").alias("first_status"), F.max("order_id").alias("last_id"),
    )


@query("a07_carried_constant", """
    select i.seller_id, v.seller_state, count(*) as lines from v_items i join v_sellers v using (seller_id) group by all""")
def a07(t):
    lines = t.order_items.groupBy("seller_id").agg(F.count("*").alias("lines")).join(t.sellers, "seller_id")
    return lines.groupBy("seller_id").agg(F.max("seller_state").alias("seller_state"), F.max("lines").alias("lines"))


@query("a08_bool_or", DATED + """
    select c.customer_unique_id as person, bool_or(d.arrived > d.promised) as ever_late
    from dated d join v_customers c using (customer_id) group by 1""")
def a08(t):
    people = t.customers.select("customer_id", F.col("customer_unique_id").alias("person"))
    return base.dated_deliveries(t).join(people, "customer_id").groupBy("person").agg(F.bool_or("is_late").alias("ever_late"))


@query("a09_filtered_count", """
    select seller_id, count(*) filter (price >= 50000) as dear_lines, count(*) as lines from v_items group by 1""")
def a09(t):
    return t.order_items.groupBy("seller_id").agg(
        F.count_if(F.col("price") >= 50000).alias("dear_lines"), F.count("*").alias("lines")
    )


@query("a10_filtered_average", DATED + """
    select c.customer_state, round(cast(sum(d.arrived - d.promised) filter (d.arrived > d.promised) as double)
           / nullif(count(*) filter (d.arrived > d.promised), 0), 3) as avg_days_late
    from dated d join v_customers c using (customer_id) group by 1""")
def a10(t):
    return base.with_state(t, base.dated_deliveries(t)).groupBy("customer_state").agg(
        mean("days_vs_promise", 3, where=F.col("is_late")).alias("avg_days_late")
    )


@query("a11_pivot_sum", """
    select c.customer_state, round(cast(sum(v.revenue) filter (year(v.bought_at) = 1995) as double), 2) as y1995,
           round(cast(sum(v.revenue) filter (year(v.bought_at) = 1996) as double), 2) as y1996,
           round(cast(sum(v.revenue) filter (year(v.bought_at) = 1997) as double), 2) as y1997
    from v_order_value v join v_customers c using (customer_id) group by 1""")
def a11(t):
    sold = base.with_state(t, base.order_revenue(t)).withColumn("year", F.year("order_purchase_timestamp"))
    wide = sold.groupBy("customer_state").pivot("year", [1995, 1996, 1997]).agg(F.sum("revenue"))
    return wide.select("customer_state", *[money_out(F.col(str(y))).alias(f"y{y}") for y in (1995, 1996, 1997)])


@query("a12_global_aggregate", """
    select count(*) as lines, round(cast(sum(price) as double), 2) as revenue_brl, min(order_id) as first_order from v_items""")
def a12(t):
    return t.order_items.agg(F.count("*").alias("lines"), money_out(F.sum("price")).alias("revenue_brl"),
                             F.min("order_id").alias("first_order"))


@query("a13_group_by_columns", """
    select order_status, cast(date_trunc('quarter', order_purchase_timestamp) as date) as quarter, count(*) as orders
    from v_orders group by 1, 2""")
def a13(t):
    return t.orders.groupBy("order_status", quarter_of("order_purchase_timestamp").alias("quarter")).agg(
        F.count("*").alias("orders"))


@query("a14_group_by_computed", DATED + """
    select case when arrived > promised then 'late' when arrived = promised then 'that day' else 'early' end as outcome,
           count(*) as orders from dated group by outcome""")
def a14(t):
    gap = F.col("days_vs_promise")
    outcome = F.when(gap > 0, "late").when(gap == 0, "that day").otherwise("early")
    return base.dated_deliveries(t).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("orders"))


@query("a15_having", "select product_id, count(*) as lines from v_items group by 1 having count(*) >= 40")
def a15(t):
    return t.order_items.groupBy("product_id").agg(F.count("*").alias("lines")).filter(F.col("lines") >= 40)


@query("a16_multi_level", """
    select n as orders_per_person, count(*) as people, round(cast(sum(v) as double), 2) as revenue_brl
    from (select person, count(*) as n, sum(revenue) as v from v_order_value group by 1) group by 1""")
def a16(t):
    return customers.lifetime_values(t).groupBy(F.col("orders").alias("orders_per_person")).agg(
        F.count("*").alias("people"), money_out(F.sum("lifetime_value")).alias("revenue_brl")
    )


@query("a17_select_distinct", "select distinct order_id, seller_id from v_items")
def a17(t):
    return t.order_items.select("order_id", "seller_id").distinct()


@query("a18_guarded_ratio", """
    select v.customer_state, round(cast(sum(r.score) as double) / nullif(cast(count(r.score) as double), 0), 4) as score_per_review
    from v_customers v left join (
        select order_id, sum(review_score) as score from v_reviews where review_score = 5 group by 1) r
      on r.order_id = v.customer_id and r.score > 5
    group by 1""")
def a18(t):
    top = t.order_reviews.filter(F.col("review_score") == 5).groupBy("order_id").agg(F.sum("review_score").alias("score"))
    joined = t.customers.select("customer_id", "customer_state").join(
        top.filter(F.col("score") > 5), F.col("customer_id") == F.col("order_id"), "left")
    return joined.groupBy("customer_state").agg(quotient(F.sum("score"), F.count("score"), 4).alias("score_per_review"))


@query("a19_window_over_aggregate", """
    select order_status, count(*) as orders, cast(sum(count(*)) over () as bigint) as all_orders,
           round(100.0 * count(*) / cast(sum(count(*)) over () as double), 2) as pct_of_orders
    from v_orders group by 1""")
def a19(t):
    # One row per status under the window.
    everything = F.sum("orders").over(W.partitionBy())
    return t.orders.groupBy("order_status").agg(F.count("*").alias("orders")).select(
        "order_status", "orders", everything.alias("all_orders"), pct("orders", everything, 2).alias("pct_of_orders")
    )


@query("a20_partial_and_final", """
    select product_id, count(*) as lines, round(cast(sum(price) as double), 2) as revenue_brl,
           round(cast(max(price) as double), 2) as dearest_brl from v_items group by 1""")
def a20(t):
    return t.order_items.groupBy("product_id").agg(
        F.count("*").alias("lines"), money_out(F.sum("price")).alias("revenue_brl"), money_out(F.max("price")).alias("dearest_brl")
    )


@query("a21_summary_per_bucket", """
    select bucket, count(*) as people, round(cast(min(v) as double), 2) as smallest_brl, round(cast(max(v) as double), 2) as largest_brl
    from (select v, ntile(4) over (order by v desc, person) as bucket
          from (select person, sum(revenue) as v from v_order_value group by 1))
    group by 1""")
def a21(t):
    return ntile(customers.lifetime_values(t), [F.desc("lifetime_value"), "customer_unique_id"], 4, "bucket").groupBy("bucket").agg(
        F.count("*").alias("people"), money_out(F.min("lifetime_value")).alias("smallest_brl"),
        money_out(F.max("lifetime_value")).alias("largest_brl"),
    )


@query("a04_mergeable_bitmaps", """
    with levels as (
        select 0 as depth, '' as node, person, order_id from v_order_value
        where bought_at >= timestamp '1995-03-01' and bought_at < timestamp '1996-02-01'
        union all
        select 1, left(zip, 1), person, order_id from v_order_value
        where bought_at >= timestamp '1995-03-01' and bought_at < timestamp '1996-02-01')
    select depth, node, count(distinct person) as people, count(distinct order_id) as orders from levels group by all""")
def a04_bitmaps(t):
    # Bitmaps per month and first digit of the zip; eleven months are merged, per digit and over all.
    people = t.customers.select("customer_id", F.col("customer_unique_id").alias("person"), F.left("customer_zip_code_prefix", F.lit(1)).alias("node"))
    facts = cut_lineage(base.order_revenue(t).join(people, "customer_id").select(
        month_of("order_purchase_timestamp").alias("month"), "node", "person", "order_id"))
    made = {name: stored_bitmaps(facts, ["month", "node"], column) for column, name in (("person", "people"), ("order_id", "orders"))}

    def counts(depth: int) -> DataFrame:
        node = F.left("node", F.lit(depth))
        of = {name: count_distinct(b.filter(F.col("month").between("1995-03-01", "1996-01-01")).withColumn("node", node), ["node"], name)
              for name, b in made.items()}
        return of["people"].join(of["orders"], "node").select(F.lit(depth).alias("depth"), "node", "people", "orders")

    return counts(0).unionByName(counts(1))
