"""Joins (inventory group J)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import money_out, month_of, pct, quotient, year_month
from ..operators.hierarchy import with_ancestors
from ..operators.joins import grand_total, labelled, orphans, per_parent, repeated_sum, role_join, small_side
from ..operators.skew import join_per_key
from ..operators.series import densify, month_spine
from ..operators.topk import top_k
from ..plans import base, trend
from ..sources.buckets import BucketedTables
from ..sources.durable import cut_lineage
from .registry import query
from .reports import EARLY_MONTHS, GAP


@query("j01_inner_join", """
    select i.order_id, i.order_item_id, o.order_status from v_items i join v_orders o on o.order_id = i.order_id""")
def j01(t):
    return t.order_items.select("order_id", F.col("order_item_id").cast("int").alias("order_item_id")).join(
        t.orders.select("order_id", "order_status"), "order_id"
    )


@query("j02_star_join", """
    select c.customer_state, v.seller_state, count(*) as lines, round(cast(sum(s.price) as double), 2) as revenue_brl
    from v_sold s join v_customers c using (customer_id) join v_sellers v using (seller_id) join v_products p using (product_id)
    where p.product_category_name is not null group by all""")
def j02(t):
    orders = base.with_state(t, base.delivered_orders(t).select("order_id", "customer_id"))
    lines = t.order_items.select("order_id", "product_id", "seller_id", "price").join(orders, "order_id")
    # Down to (state, product, seller) before the dimensions are joined.
    small = lines.groupBy("customer_state", "product_id", "seller_id").agg(
        F.sum("price").alias("revenue"), F.count("*").alias("lines"))
    return (
        small.join(base.categories(t).select("product_id"), "product_id")
        .join(t.sellers.select("seller_id", "seller_state"), "seller_id")
        .groupBy("customer_state", "seller_state")
        .agg(F.sum("lines").alias("lines"), money_out(F.sum("revenue")).alias("revenue_brl"))
    )


@query("j03_left_join", """
    select o.order_id, p.paid_brl from v_orders o
    left join (select order_id, round(cast(sum(payment_value) as double), 2) as paid_brl from v_payments group by 1) p
      on p.order_id = o.order_id""")
def j03(t):
    paid = per_parent(t.order_payments, "order_id", paid_brl=money_out(F.sum("payment_value")))
    return t.orders.select("order_id").join(paid, "order_id", "left")


@query("j04_incomplete_lookup", "select product_id, category from v_labelled where category is not null")
def j04(t):
    named = t.products.filter(F.col("product_category_name").isNotNull())
    return labelled(named, t.translation, "product_category_name", "product_category_name_english", "category").select(
        "product_id", "category"
    )


@query("j05_densify", EARLY_MONTHS + """
    select cast(g.m as date) as month, round(cast(coalesce(s.revenue, 0) as double), 2) as revenue_brl
    from generate_series(timestamp '1995-01-01', timestamp '1995-08-01', interval 1 month) g(m)
    left join sparse s on s.month = cast(g.m as date)""")
def j05(t):
    sparse = base.monthly_revenue(t, trend.gappy_orders(t, **GAP))
    dense = densify(month_spine(t.spark, "1995-01-01", "1995-08-01"), sparse, {"revenue": 0})
    return dense.select("month", money_out("revenue").alias("revenue_brl"))


@query("j06_role_playing_dimension", """
    select x.order_id, x.customer_zip, x.seller_zip, round(a.lat, 6) as customer_lat, round(b.lat, 6) as seller_lat
    from (select distinct i.order_id, c.customer_zip_code_prefix as customer_zip, s.seller_zip_code_prefix as seller_zip
          from v_items i join v_orders o using (order_id) join v_customers c using (customer_id) join v_sellers s using (seller_id)) x
    left join v_centroid a on a.zip = x.customer_zip left join v_centroid b on b.zip = x.seller_zip""")
def j06(t):
    places = t.orders.select("order_id", "customer_id").join(
        t.customers.select("customer_id", F.col("customer_zip_code_prefix").alias("customer_zip")), "customer_id")
    sellers = t.sellers.select("seller_id", F.col("seller_zip_code_prefix").alias("seller_zip"))
    legs = base.order_sellers(t, places.drop("customer_id")).join(sellers, "seller_id").select(
        "order_id", "customer_zip", "seller_zip").distinct()
    # Counted to be small, the centroids are broadcast; a larger table is joined from
    # its files, so that a hot zip is split.
    points = small_side(cut_lineage(t.geolocation_centroid.select("zip", F.round("lat", 6).alias("lat"))))
    return role_join(legs, points, "zip", [("customer_zip", "customer"), ("seller_zip", "seller")]).select(
        "order_id", "customer_zip", "seller_zip", "customer_lat", "seller_lat"
    )


@query("j07_join_with_total", """
    select s.seller_id, round(100.0 * cast(s.revenue as double) / cast(n.total as double), 2) as pct_of_all
    from (select seller_id, sum(price) as revenue from v_sold group by 1) s cross join (select sum(price) as total from v_sold) n""")
def j07(t):
    sellers = cut_lineage(base.seller_revenue(t))
    return sellers.select("seller_id", pct("revenue", grand_total(sellers, F.sum("revenue")), 2).alias("pct_of_all"))


@query("j08_prefix_join", """
    select n.node, count(*) as customers, cast(length(n.node) as bigint) as depth
    from (select distinct left(customer_zip_code_prefix, d) as node from v_customers, (values (1), (2), (3)) x(d)) n
    join v_customers c on left(c.customer_zip_code_prefix, length(n.node)) = n.node group by all""")
def j08(t):
    zips = t.customers.groupBy("customer_zip_code_prefix").agg(F.count("*").alias("n"))
    return with_ancestors(zips, "customer_zip_code_prefix", 3).groupBy("depth", "node").agg(
        F.sum("n").alias("customers")
    ).select("node", "customers", F.col("depth").cast("long").alias("depth"))


@query("j09_semi_join_top_n", """
    select seller_id, seller_state from v_sellers where seller_state in (
        select v.seller_state from v_sold x join v_sellers v using (seller_id)
        group by 1 order by sum(x.price) desc, 1 limit 5)""")
def j09(t):
    states = base.seller_revenue(t).join(t.sellers, "seller_id").groupBy("seller_state").agg(F.sum("revenue").alias("revenue"))
    largest = top_k(states, 5, [F.desc("revenue"), "seller_state"])
    return t.sellers.join(largest, "seller_state", "left_semi").select("seller_id", "seller_state")


@query("j10_anti_join", """
    select distinct product_category_name from v_products p
    where product_category_name is not null
      and not exists (select 1 from v_translation t where t.product_category_name = p.product_category_name)""")
def j10(t):
    names = t.products.select("product_category_name").distinct()
    return orphans(names, "product_category_name", t.translation, "product_category_name")


@query("j11_detail_of_top_groups", """
    with p as (select product_id, sum(price) as revenue, count(*) as units from v_sold group by 1),
    l as (select p.*, v.category from p join v_labelled v using (product_id) where v.category is not null),
    c as (select category from l group by 1 order by sum(units) desc, category limit 3)
    select category, product_id, units, round(cast(revenue as double), 2) as revenue_brl from l join c using (category)""")
def j11(t):
    products = cut_lineage(base.product_revenue(t).join(base.categories(t), "product_id"))
    busiest = top_k(products.groupBy("category").agg(F.sum("units_sold").alias("u")), 3, [F.desc("u"), "category"])
    return products.join(busiest.select("category"), "category").select(
        "category", "product_id", F.col("units_sold").alias("units"), money_out("revenue").alias("revenue_brl")
    )


@query("j12_detail_of_having_groups", """
    select order_id, customer_unique_id as person from v_customers c join v_orders o using (customer_id)
    where customer_unique_id in (select customer_unique_id from v_customers group by 1 having count(*) >= 15)""")
def j12(t):
    people = cut_lineage(t.customers.select("customer_id", F.col("customer_unique_id").alias("person")))
    frequent = people.groupBy("person").agg(F.count("*").alias("n")).filter(F.col("n") >= 15)
    return join_per_key(people, frequent, ["person"], "n").join(
        t.orders.select("order_id", "customer_id"), "customer_id"
    ).select("order_id", "person")


@query("j13_compare_two_series", EARLY_MONTHS + """,
    n as (select month, lag(month) over (order by month) as prev from sparse)
    select strftime(cast(g.m as date), '%Y-%m') as month, strftime(n.prev, '%Y-%m') as naive_prev_month,
           strftime(cast(g.m - interval 1 month as date), '%Y-%m') as true_prev_month
    from generate_series(timestamp '1995-01-01', timestamp '1995-08-01', interval 1 month) g(m)
    left join n on n.month = cast(g.m as date)""")
def j13(t):
    naive = base.monthly_revenue(t, trend.gappy_orders(t, **GAP)).select(
        "month", F.lag("month").over(W.orderBy("month")).alias("prev"))
    return month_spine(t.spark, "1995-01-01", "1995-08-01").join(naive, "month", "left").select(
        year_month("month").alias("month"), year_month("prev").alias("naive_prev_month"),
        year_month(F.add_months("month", -1)).alias("true_prev_month"),
    )


@query("j14_preaggregated_children", """
    select o.order_id, i.items_brl, p.paid_brl from v_orders o
    join (select order_id, round(cast(sum(price) as double), 2) as items_brl from v_items group by 1) i using (order_id)
    left join (select order_id, round(cast(sum(payment_value) as double), 2) as paid_brl from v_payments group by 1) p using (order_id)""")
def j14(t):
    items = per_parent(t.order_items, "order_id", items_brl=money_out(F.sum("price")))
    paid = per_parent(t.order_payments, "order_id", paid_brl=money_out(F.sum("payment_value")))
    return t.orders.select("order_id").join(items, "order_id").join(paid, "order_id", "left")


@query("j14_co_bucketed_children", """
    with i as (select order_id, sum(price) as items, count(*) as lines from v_items group by 1),
    p as (select order_id, sum(payment_value) as paid, count(*) as payments from v_payments group by 1)
    select cast(date_trunc('month', o.order_purchase_timestamp) as date) as month, count(*) as orders,
           cast(sum(lines) as bigint) as lines, cast(sum(payments) as bigint) as payments,
           round(cast(sum(items) as double), 2) as items_brl, round(cast(sum(paid) as double), 2) as paid_brl
    from v_orders o join i using (order_id) left join p using (order_id) group by 1""")
def j14_co_bucketed(t):
    # Orders, lines and payments lie together: only the months are shuffled.
    b = BucketedTables(t)
    items = per_parent(b.order_items, "order_id", items=F.sum("price"), lines=F.count("*"))
    paid = per_parent(b.order_payments, "order_id", paid=F.sum("payment_value"), payments=F.count("*"))
    joined = b.orders.select("order_id", "order_purchase_timestamp").join(items, "order_id").join(paid, "order_id", "left")
    return joined.groupBy(month_of("order_purchase_timestamp").alias("month")).agg(
        F.count("*").alias("orders"), F.sum("lines").alias("lines"), F.sum("payments").alias("payments"),
        money_out(F.sum("items")).alias("items_brl"), money_out(F.sum("paid")).alias("paid_brl"))


@query("j15_fan_out_inflation", """
    select count(*) as joined_rows, count(distinct (order_id, order_item_id)) as true_lines,
           round(cast(sum(price) as double), 2) as inflated_brl
    from v_items join v_payments using (order_id)""")
def j15(t):
    # Counted per order; the inflated rows themselves are never produced.
    items = per_parent(
        t.order_items.groupBy("order_id", "order_item_id").agg(F.count("*").alias("n"), F.sum("price").alias("v")),
        "order_id", rows=F.sum("n"), distinct_lines=F.count("*"), value=F.sum("v"),
    )
    payments = per_parent(t.order_payments, "order_id", payments=F.count("*"))
    return items.join(payments, "order_id").agg(
        F.sum(F.col("rows") * F.col("payments")).alias("joined_rows"),
        F.sum("distinct_lines").alias("true_lines"),
        money_out(repeated_sum("value", "payments")).alias("inflated_brl"),
    )


@query("j16_raw_point_fan_out", """
    select c.customer_state, count(*) as joined_rows, count(distinct c.customer_id) as customers,
           round(count(*) / count(distinct c.customer_id), 2) as rows_per_customer
    from v_customers c join v_geo g on g.zip = c.customer_zip_code_prefix group by 1""")
def j16(t):
    zips = t.customers.groupBy("customer_state", F.col("customer_zip_code_prefix").alias("zip")).agg(F.count("*").alias("n"))
    points = t.geolocation_centroid.select("zip", "source_rows")
    return zips.join(points, "zip").groupBy("customer_state").agg(
        F.sum(F.col("n") * F.col("source_rows")).alias("joined_rows"), F.sum("n").alias("customers")
    ).withColumn("rows_per_customer", quotient("joined_rows", "customers", 2))
