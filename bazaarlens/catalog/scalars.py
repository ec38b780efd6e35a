"""Scalar functions and operators (inventory group F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import band, day, money_out, month_of, quarter_of, quotient, year_month
from ..plans import base, delivery
from .registry import query
from .reports import DATED

PLACED = "order_purchase_timestamp"


@query("f01_left", "select customer_id, left(customer_zip_code_prefix, 3) as area from v_customers")
def f01(t):
    return t.customers.select("customer_id", F.left("customer_zip_code_prefix", F.lit(3)).alias("area"))


@query("f01_left_variable", """
    select customer_id, left(customer_zip_code_prefix, cast(1 + customer_id % 5 as integer)) as node from v_customers""")
def f01_variable(t):
    length = (F.lit(1) + F.col("customer_id") % 5).cast("int")
    return t.customers.select("customer_id", F.left("customer_zip_code_prefix", length).alias("node"))


@query("f02_coalesce", "select product_id, coalesce(product_category_name, 'none') as category from v_products")
def f02(t):
    return t.products.select("product_id", F.coalesce("product_category_name", F.lit("none")).alias("category"))


@query("f03_nullif", """
    select order_id, order_item_id, round(cast(price as double) / nullif(cast(freight_value - 25 as double), 0), 6) as per_unit from v_items""")
def f03(t):
    per_unit = quotient("price", F.col("freight_value") - 25, 6)
    return t.order_items.select("order_id", F.col("order_item_id").cast("int").alias("order_item_id"), per_unit.alias("per_unit"))


@query("f04_round", """
    select seller_id, round(s / 1000.0, 1) as thousands, round(s / 1000.0, 2) as thousands_2, round(s / 1000.0, 3) as thousands_3
    from (select seller_id, cast(sum(cast(price as decimal(15,0))) as double) as s from v_items group by 1)""")
def f04(t):
    total = F.sum(F.col("price").cast("decimal(15,0)"))
    sellers = t.order_items.groupBy("seller_id").agg(total.alias("s"))
    return sellers.select("seller_id", *[
        quotient("s", F.lit(1000), digits).alias(name)
        for digits, name in ((1, "thousands"), (2, "thousands_2"), (3, "thousands_3"))
    ])


@query("f05_arithmetic", """
    select order_id, order_item_id, round(cast(price + freight_value as double), 2) as total_brl,
           round(cast(price - freight_value as double), 2) as net_brl,
           round(100.0 * cast(freight_value as double) / cast(price as double), 4) as freight_pct from v_items""")
def f05(t):
    price, freight = F.col("price"), F.col("freight_value")
    return t.order_items.select(
        "order_id", F.col("order_item_id").cast("int").alias("order_item_id"),
        money_out(price + freight).alias("total_brl"), money_out(price - freight).alias("net_brl"),
        quotient(F.lit(100) * freight, price, 4).alias("freight_pct"))


@query("f06_truncated_dates", """
    select order_id, cast(date_trunc('month', order_purchase_timestamp) as date) as month,
           cast(date_trunc('quarter', order_purchase_timestamp) as date) as quarter from v_orders""")
def f06(t):
    return t.orders.select("order_id", month_of(PLACED).alias("month"), quarter_of(PLACED).alias("quarter"))


@query("f07_casts", """
    select order_id, cast(order_delivered_customer_date as date) as arrived_on, cast(order_id as varchar) as order_text,
           cast(order_id as double) as order_number from v_orders""")
def f07(t):
    return t.orders.select("order_id", day("order_delivered_customer_date").alias("arrived_on"),
                           F.col("order_id").cast("string").alias("order_text"), F.col("order_id").cast("double").alias("order_number"))


@query("f08_days_between", DATED + "select order_id, arrived - bought as to_deliver, arrived - promised as vs_promise from dated")
def f08(t):
    return base.dated_deliveries(t).select("order_id", F.col("days_to_deliver").alias("to_deliver"),
                                           F.col("days_vs_promise").alias("vs_promise"))


@query("f09_late_by_day_and_by_instant", """
    select order_id, order_delivered_customer_date > order_estimated_delivery_date as late_by_instant,
           cast(order_delivered_customer_date as date) > cast(order_estimated_delivery_date as date) as late_by_day from v_orders""")
def f09(t):
    arrived, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    return t.orders.select("order_id", (F.col(arrived) > F.col(promised)).alias("late_by_instant"),
                           (day(arrived) > day(promised)).alias("late_by_day"))


@query("f10_year_month_text", "select order_id, strftime(order_purchase_timestamp, '%Y-%m') as month from v_orders")
def f10(t):
    return t.orders.select("order_id", year_month(PLACED).alias("month"))


@query("f11_haversine", """
    select c.zip as customer_zip, s.zip as seller_zip, round(2 * 6371 * asin(sqrt(power(sin(radians(c.lat - s.lat) / 2), 2)
           + cos(radians(s.lat)) * cos(radians(c.lat)) * power(sin(radians(c.lng - s.lng) / 2), 2))), 4) as km
    from (select distinct v.customer_zip_code_prefix as a, w.seller_zip_code_prefix as b
          from v_sold i join v_customers v using (customer_id) join v_sellers w using (seller_id)) p
    join v_centroid c on c.zip = p.a join v_centroid s on s.zip = p.b""")
def f11(t):
    orders = base.delivered_orders(t).select("order_id", "customer_id").join(
        t.customers.select("customer_id", F.col("customer_zip_code_prefix").alias("customer_zip")), "customer_id")
    sellers = t.sellers.select("seller_id", F.col("seller_zip_code_prefix").alias("seller_zip"))
    pairs = base.order_sellers(t, orders.select("order_id", "customer_zip")).join(sellers, "seller_id").select(
        "customer_zip", "seller_zip").distinct()
    known = delivery.with_distance(pairs, t.geolocation_centroid).filter(F.col("km").isNotNull())
    return known.withColumn("km", F.round("km", 4))


@query("f12_typed_literals", """
    select order_id from v_orders where order_purchase_timestamp >= timestamp '1999-12-31 00:00:00'
      and cast(order_purchase_timestamp as date) <> date '2000-01-01'""")
def f12(t):
    after = F.col(PLACED) >= F.lit("1999-12-31 00:00:00").cast("timestamp_ntz")
    return t.orders.filter(after & (day(PLACED) != F.lit("2000-01-01").cast("date"))).select("order_id")


@query("f13_three_valued_logic", """
    select product_id, product_category_name = 'Brand#3' or product_id % 2 = 0 as either,
           product_category_name = 'Brand#3' and product_id % 2 = 0 as both from v_products""")
def f13(t):
    named, even = F.col("product_category_name") == "Brand#3", F.col("product_id") % 2 == 0
    return t.products.select("product_id", (named | even).alias("either"), (named & even).alias("both"))


@query("f14_sorted_band_labels", DATED + """
    select order_id, case when arrived <= promised then 'a. kept' when arrived - promised <= 5 then 'b. nearly kept'
           else 'c. broken' end as promise from dated""")
def f14(t):
    gap = F.col("days_vs_promise")
    promise = band([(gap <= 0, "a. kept"), (gap <= 5, "b. nearly kept")], "c. broken")
    return base.dated_deliveries(t).select("order_id", promise.alias("promise"))
