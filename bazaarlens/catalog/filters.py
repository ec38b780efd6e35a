"""Projections, filters and predicates (inventory group P)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import band, day, money_out, year_month
from ..operators.series import trailing
from ..operators.topk import top_row_numbers
from ..plans import base, trend
from .registry import query
from .reports import SERIES, WINDOW

PLACED = "order_purchase_timestamp"


def stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("p01_projection_alias", "select order_id as sale, cast(price as double) as amount_brl from v_items")
def p01(t):
    return t.order_items.select(F.col("order_id").alias("sale"), money_out("price").alias("amount_brl"))


@query("p02_star_plus_column", """
    select *, length(product_category_name) as label_length from v_products""")
def p02(t):
    return t.products.select("*", F.length("product_category_name").cast("long").alias("label_length"))


@query("p03_literal_label", """
    select 'delivered orders' as label, count(*) as orders from v_orders where order_status = 'delivered'""")
def p03(t):
    return base.delivered_orders(t).agg(F.count("*").alias("orders")).select(F.lit("delivered orders").alias("label"), "orders")


@query("p04_equality_filter", "select order_id from v_orders where order_status = 'delivered'")
def p04(t):
    return base.delivered_orders(t).select("order_id")


@query("p05_half_open_range", """
    select order_id, order_purchase_timestamp from v_orders
    where order_purchase_timestamp >= timestamp '2000-01-01' and order_purchase_timestamp < timestamp '2000-09-01'""")
def p05(t):
    inside = (F.col(PLACED) >= stamp("2000-01-01")) & (F.col(PLACED) < stamp("2000-09-01"))
    return t.orders.filter(inside).select("order_id", "order_purchase_timestamp")


@query("p06_one_sided_bound", """
    select order_id from v_orders where order_purchase_timestamp < timestamp '1995-09-01'""")
def p06(t):
    return t.orders.filter(F.col(PLACED) < stamp("1995-09-01")).select("order_id")


@query("p07_union_of_ranges", """
    select order_id, order_purchase_timestamp from v_orders
    where (order_purchase_timestamp >= timestamp '1995-04-01' and order_purchase_timestamp < timestamp '1995-07-01')
       or (order_purchase_timestamp >= timestamp '1996-04-01' and order_purchase_timestamp < timestamp '1996-07-01')""")
def p07(t):
    quarters = [("1995-04-01", "1995-07-01"), ("1996-04-01", "1996-07-01")]
    either = reduce(lambda a, b: a | b, [(F.col(PLACED) >= stamp(a)) & (F.col(PLACED) < stamp(b)) for a, b in quarters])
    return t.orders.filter(either).select("order_id", "order_purchase_timestamp")


@query("p08_is_not_null", "select product_id from v_products where product_category_name is not null")
def p08(t):
    return t.products.filter(F.col("product_category_name").isNotNull()).select("product_id")


@query("p09_is_null", "select product_id from v_products where product_category_name is null")
def p09(t):
    return t.products.filter(F.col("product_category_name").isNull()).select("product_id")


@query("p10_in_list", """
    select customer_id, customer_state from v_customers where customer_state in ('NATION_0', 'NATION_1', 'NATION_2')""")
def p10(t):
    wanted = F.col("customer_state").isin("NATION_0", "NATION_1", "NATION_2")
    return t.customers.filter(wanted).select("customer_id", "customer_state")


@query("p11_prefix_match", """
    select customer_id, customer_zip_code_prefix from v_customers where customer_zip_code_prefix like '011%'""")
def p11(t):
    zips = F.col("customer_zip_code_prefix")
    return t.customers.filter(zips.startswith("011")).select("customer_id", zips)


@query("p12_list_or_conjunction", """
    select customer_id, customer_zip_code_prefix as zip, customer_state from v_customers
    where customer_state in ('NATION_3', 'NATION_4')
       or (customer_zip_code_prefix like '01%' and customer_state = 'NATION_5')""")
def p12(t):
    state, zips = F.col("customer_state"), F.col("customer_zip_code_prefix")
    kept = state.isin("NATION_3", "NATION_4") | (zips.startswith("01") & (state == "NATION_5"))
    return t.customers.filter(kept).select("customer_id", zips.alias("zip"), "customer_state")


@query("p13_filter_on_window", """
    select category, product_id, units from (
        select l.category, s.product_id, count(*) as units
        from v_sold s join v_labelled l using (product_id) where l.category is not null group by all)
    qualify row_number() over (partition by category order by units desc, product_id) <= 2""")
def p13(t):
    units = base.product_revenue(t).join(base.categories(t), "product_id")
    return top_row_numbers(units, "category", [F.desc("units_sold"), "product_id"], 2).select(
        "category", "product_id", F.col("units_sold").alias("units")
    )


@query("p14_filter_after_window", SERIES + """
    select strftime(month, '%Y-%m') as month, round(cast(pr as double), 2) as prev_month_brl
    from (select month, lag(revenue) over (order by month) as pr from series) where month >= date '1998-01-01'""")
def p14(t):
    series = trend.clean_series(t, **WINDOW).withColumn("prev", F.lag("revenue").over(W.orderBy("month")))
    return series.filter(F.col("month") >= F.lit("1998-01-01").cast("date")).select(
        year_month("month").alias("month"), money_out("prev").alias("prev_month_brl")
    )


@query("p15_threshold_crossing", SERIES + """,
    x as (select month, cast(sum(revenue) over (order by month) as double) as upto,
                 coalesce(cast(sum(revenue) over (order by month rows between unbounded preceding and 1 preceding) as double), 0) as before
          from series),
    y as (select x.*, (select max(upto) from x) as total from x)
    select strftime(month, '%Y-%m') as month from y
    where (upto >= 0.25 * total and before < 0.25 * total) or (upto >= 0.5 * total and before < 0.5 * total)
       or (upto >= 0.75 * total and before < 0.75 * total)""")
def p15(t):
    # The crossing rows of a monthly series, which the calendar bounds.
    running = F.sum("revenue").over(W.orderBy("month")).cast("double")
    before = F.coalesce(F.sum("revenue").over(W.orderBy("month").rowsBetween(W.unboundedPreceding, -1)).cast("double"), F.lit(0.0))
    total = F.sum("revenue").over(W.partitionBy()).cast("double")
    series = trend.clean_series(t, **WINDOW).select("month", running.alias("a"), before.alias("b"), total.alias("t"))
    crossed = reduce(
        lambda x, y: x | y,
        [(F.col("a") >= cut * F.col("t")) & (F.col("b") < cut * F.col("t")) for cut in (0.25, 0.5, 0.75)],
    )
    return series.filter(crossed).select(year_month("month").alias("month"))


@query("p16_case_with_else", """
    select order_id, order_item_id, cast(price as double) as price_brl,
           case when price >= 50000 then 'a. dear' when price >= 10000 then 'b. middling' else 'c. cheap' end as price_band
    from v_items""")
def p16(t):
    price = F.col("price")
    label = band([(price >= 50000, "a. dear"), (price >= 10000, "b. middling")], "c. cheap")
    return t.order_items.select("order_id", F.col("order_item_id").cast("int").alias("order_item_id"),
                                money_out(price).alias("price_brl"), label.alias("price_band"))


@query("p17_case_without_else", """
    select order_id, case when order_status = 'delivered' then order_delivered_customer_date end as arrived from v_orders""")
def p17(t):
    arrived = F.when(F.col("order_status") == "delivered", F.col("order_delivered_customer_date"))
    return t.orders.select("order_id", arrived.alias("arrived"))


@query("p18_boolean_column", """
    select order_id, cast(order_delivered_customer_date as date) > cast(order_estimated_delivery_date as date) as is_late
    from v_orders""")
def p18(t):
    late = day("order_delivered_customer_date") > day("order_estimated_delivery_date")
    return t.orders.select("order_id", late.alias("is_late"))


@query("p19_minimum_on_both_sides", """
    select l.category from v_sold s join v_labelled l using (product_id) where l.category is not null
    group by 1
    having sum(case when year(s.bought_at) = 1995 then s.price else 0 end) >= 1000000
       and sum(case when year(s.bought_at) = 1996 then s.price else 0 end) >= 1000000""")
def p19(t):
    orders = base.delivered_orders(t).select("order_id", F.year(PLACED).alias("year")).filter(F.col("year").isin(1995, 1996))
    per_product = t.order_items.select("order_id", "product_id", "price").join(orders, "order_id").groupBy(
        "product_id", "year").agg(F.sum("price").alias("revenue"))
    both = per_product.join(base.categories(t), "product_id").groupBy("category").agg(*[
        F.sum(F.when(F.col("year") == y, F.col("revenue"))).alias(f"y{y}") for y in (1995, 1996)
    ])
    return both.filter((F.col("y1995") >= 1_000_000) & (F.col("y1996") >= 1_000_000)).select("category")


@query("p20_both_ends", """
    with s as (select v.seller_state as state, sum(x.price) as revenue from v_sold x join v_sellers v using (seller_id) group by 1)
    select state, up, down from (
        select state, rank() over (order by revenue desc) as up, rank() over (order by revenue) as down from s)
    where up <= 3 or down <= 2""")
def p20(t):
    # One row per state.
    states = base.seller_revenue(t).join(t.sellers, "seller_id").groupBy("seller_state").agg(F.sum("revenue").alias("revenue"))
    ranked = states.select(
        F.col("seller_state").alias("state"),
        F.rank().over(W.orderBy(F.desc("revenue"))).cast("long").alias("up"),
        F.rank().over(W.orderBy("revenue")).cast("long").alias("down"),
    )
    return ranked.filter((F.col("up") <= 3) | (F.col("down") <= 2))


@query("p21_between", """
    select review_id, order_id, cast(review_score as integer) as review_score from v_reviews where review_score between 2 and 4""")
def p21(t):
    return t.order_reviews.filter(F.col("review_score").between(2, 4))
