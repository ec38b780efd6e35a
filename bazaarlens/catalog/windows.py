"""Window functions and frames (inventory group W).

Windows over monthly series are plain, because the calendar bounds them. Windows
over sellers, products, people or orders use the distributed scan: any of those
groups may hold a large part of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import days_between, money_out, month_of, months_index, pct, year_month
from ..operators.frames import trailing_range, trailing_rows
from ..operators.joins import grand_total
from ..operators.ordered import ntile, ordered_scan, running_with_peers, value_ranks
from ..operators.series import full_frame_only, trailing
from ..operators.topk import share_of_group
from ..plans import base, ranking, trend
from ..sources.durable import cut_lineage
from .registry import query
from .reports import SERIES, WINDOW

UNITS = "with u as (select product_id, count(*) as n, sum(price) as revenue from v_sold group by 1)"
UNITS_LABELLED = """
    with u as (
        select l.category, s.product_id, count(*) as n, sum(s.price) as revenue
        from v_sold s join v_labelled l using (product_id) where l.category is not null group by all)"""
STATE_MONTHS = """
    with sm as (
        select state, cast(date_trunc('month', bought_at) as date) as month, sum(revenue) as revenue
        from v_order_value group by all)"""


def units(t) -> DataFrame:
    return cut_lineage(base.product_revenue(t))


def units_labelled(t) -> DataFrame:
    return cut_lineage(base.product_revenue(t).join(base.categories(t), "product_id"))


def series(t) -> DataFrame:
    return trend.clean_series(t, **WINDOW)


def state_months(t) -> DataFrame:
    """Every month of every state."""
    sold = base.with_state(t, base.order_revenue(t))
    return sold.groupBy("customer_state", month_of("order_purchase_timestamp").alias("month")).agg(
        F.sum("revenue").alias("revenue"))


def person_values(t) -> DataFrame:
    """Order values with the person who placed them."""
    people = t.customers.select("customer_id", F.col("customer_unique_id").alias("person"))
    return base.order_revenue(t).join(people, "customer_id").select(
        "person", "order_id", F.col("order_purchase_timestamp").alias("bought_at"), "revenue")


@query("w01_row_number", UNITS + """
    select product_id, n as units_sold, row_number() over (order by n desc, product_id) as place from u""")
def w01(t):
    return ordered_scan(base.product_revenue(t), [F.desc("units_sold"), "product_id"], number="place").select(
        "product_id", "units_sold", "place")


@query("w02_rank", UNITS_LABELLED + """
    select category, product_id, n as units_sold, rank() over (order by n desc) as overall_rank,
           rank() over (partition by category order by n desc) as category_rank from u""")
def w02(t):
    overall = value_ranks(units_labelled(t), "units_sold", rank="overall_rank")
    return value_ranks(cut_lineage(overall), "units_sold", ["category"], rank="category_rank").select(
        "category", "product_id", "units_sold", "overall_rank", "category_rank")


@query("w03_dense_rank", UNITS_LABELLED + """
    select category, product_id, n as units_sold, dense_rank() over (order by n desc) as overall_rank,
           dense_rank() over (partition by category order by n desc) as category_rank from u""")
def w03(t):
    overall = value_ranks(units_labelled(t), "units_sold", rank=None, dense_rank="overall_rank")
    return value_ranks(cut_lineage(overall), "units_sold", ["category"], rank=None, dense_rank="category_rank").select(
        "category", "product_id", "units_sold", "overall_rank", "category_rank")


@query("w04_ntile", UNITS + """
    select product_id, ntile(7) over (order by revenue desc, product_id) as bucket from u""")
def w04(t):
    return ntile(base.product_revenue(t), [F.desc("revenue"), "product_id"], 7, "bucket").select("product_id", "bucket")


@query("w05_lag", SERIES + """
    select strftime(month, '%Y-%m') as month, strftime(lag(month) over (order by month), '%Y-%m') as prev_month,
           round(cast(lag(revenue) over (order by month) as double), 2) as prev_brl from series""")
def w05(t):
    return series(t).select(
        year_month("month").alias("month"), year_month(F.lag("month").over(trend.by_month())).alias("prev_month"),
        money_out(F.lag("revenue").over(trend.by_month())).alias("prev_brl"))


@query("w06_lag_twelve", SERIES + """
    select strftime(month, '%Y-%m') as month, round(cast(lag(revenue, 12) over (order by month) as double), 2) as last_year_brl
    from series""")
def w06(t):
    return series(t).select(
        year_month("month").alias("month"), money_out(F.lag("revenue", 12).over(trend.by_month())).alias("last_year_brl"))


@query("w07_lead", SERIES + """
    select strftime(month, '%Y-%m') as month, round(cast(lead(revenue) over (order by month) as double), 2) as next_brl from series""")
def w07(t):
    return series(t).select(year_month("month").alias("month"), money_out(F.lead("revenue").over(trend.by_month())).alias("next_brl"))


@query("w08_lag_or_zero", SERIES + """
    select strftime(month, '%Y-%m') as month, round(cast(coalesce(lag(revenue) over (order by month), 0) as double), 2) as prev_or_zero_brl
    from series""")
def w08(t):
    previous = F.coalesce(F.lag("revenue").over(trend.by_month()), F.lit(0))
    return series(t).select(year_month("month").alias("month"), money_out(previous).alias("prev_or_zero_brl"))


@query("w09_first_value", STATE_MONTHS + """
    select state, strftime(month, '%Y-%m') as month,
           round(cast(first_value(revenue) over (partition by state order by revenue desc) as double), 2) as best_brl from sm""")
def w09(t):
    best = F.first_value("revenue").over(W.partitionBy("customer_state").orderBy(F.desc("revenue")))
    return state_months(t).select(
        F.col("customer_state").alias("state"), year_month("month").alias("month"), money_out(best).alias("best_brl"))


@query("w10_last_value_frames", STATE_MONTHS + """
    select state, strftime(month, '%Y-%m') as month,
           round(cast(last_value(revenue) over (partition by state order by revenue desc) as double), 2) as echo_brl,
           round(cast(last_value(revenue) over (partition by state order by revenue desc
               rows between unbounded preceding and unbounded following) as double), 2) as worst_brl from sm""")
def w10(t):
    falling = W.partitionBy("customer_state").orderBy(F.desc("revenue"))
    whole = falling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return state_months(t).select(
        F.col("customer_state").alias("state"), year_month("month").alias("month"),
        money_out(F.last_value("revenue").over(falling)).alias("echo_brl"),
        money_out(F.last_value("revenue").over(whole)).alias("worst_brl"))


@query("w11_min_max_over_partition", STATE_MONTHS + """
    select state, strftime(month, '%Y-%m') as month, round(cast(min(revenue) over (partition by state) as double), 2) as worst_brl,
           round(cast(max(revenue) over (partition by state) as double), 2) as best_brl from sm""")
def w11(t):
    state = W.partitionBy("customer_state")
    return state_months(t).select(
        F.col("customer_state").alias("state"), year_month("month").alias("month"),
        money_out(F.min("revenue").over(state)).alias("worst_brl"), money_out(F.max("revenue").over(state)).alias("best_brl"))


@query("w12_partition_total", UNITS_LABELLED + """
    select category, product_id, round(cast(sum(revenue) over (partition by category) as double), 2) as category_brl from u""")
def w12(t):
    return share_of_group(units_labelled(t), "category", "revenue").select(
        "category", "product_id", money_out("group_total").alias("category_brl"))


@query("w13_grand_total", UNITS + """
    select product_id, round(cast(sum(revenue) over () as double), 2) as all_brl, count(*) over () as products from u""")
def w13(t):
    products = units(t)
    return products.select(
        "product_id", money_out(grand_total(products, F.sum("revenue"))).alias("all_brl"),
        grand_total(products, F.count("*")).alias("products"))


@query("w14_default_frame", """
    select person, order_id, round(cast(sum(revenue) over (partition by person order by year(bought_at)) as double), 2) as upto_brl
    from v_order_value""")
def w14(t):
    orders = cut_lineage(person_values(t).withColumn("year", F.year("bought_at")))
    return running_with_peers(orders, "year", "revenue", "upto", ["person"]).select(
        "person", "order_id", money_out("upto").alias("upto_brl"))


@query("w15_rows_running_total", """
    select person, order_id, round(cast(sum(revenue) over (partition by person order by bought_at, order_id
           rows unbounded preceding) as double), 2) as upto_brl from v_order_value""")
def w15(t):
    return ordered_scan(person_values(t), ["bought_at", "order_id"], ["person"], number=None, sums={"upto": "revenue"}).select(
        "person", "order_id", money_out("upto").alias("upto_brl"))


@query("w16_unique_order_running_total", """
    select order_id, round(cast(sum(revenue) over (order by bought_at, order_id) as double), 2) as upto_brl from v_order_value""")
def w16(t):
    return ordered_scan(person_values(t), ["bought_at", "order_id"], number=None, sums={"upto": "revenue"}).select(
        "order_id", money_out("upto").alias("upto_brl"))


@query("w17_trailing_rows", SERIES + """
    select strftime(month, '%Y-%m') as month,
           round(cast(sum(revenue) over (order by month rows between 2 preceding and current row) as double), 2) as sum_3_brl,
           round(cast(sum(revenue) over (order by month rows between 5 preceding and current row) as double), 2) as sum_6_brl
    from series""")
def w17(t):
    return series(t).select(
        year_month("month").alias("month"),
        money_out(F.sum("revenue").over(trailing("month", 2))).alias("sum_3_brl"),
        money_out(F.sum("revenue").over(trailing("month", 5))).alias("sum_6_brl"))


SELLER_ORDERS = """
    with so as (select seller_id, order_id, bought_at, sum(price) as revenue from v_sold group by all)"""


def seller_orders(t):
    """One row per seller and delivered order."""
    orders = base.delivered_orders(t).select("order_id", F.col("order_purchase_timestamp").alias("bought_at"))
    return base.order_sellers(t, orders)


@query("w17_trailing_rows_per_seller", SELLER_ORDERS + """
    select seller_id, order_id, round(cast(sum(revenue) over f as double), 2) as last_3_brl, count(*) over f as rows_in_frame,
           round(cast(max(revenue) over f as double), 2) as largest_brl,
           round(cast(sum(revenue) over (partition by seller_id order by bought_at, order_id
                                         rows between 3 preceding and 1 preceding) as double), 2) as prior_3_brl
    from so window f as (partition by seller_id order by bought_at, order_id rows between 2 preceding and current row)""")
def w17_per_seller(t):
    # A seller may own a third of the orders: frames are computed in blocks with a halo.
    measures = {"last_3": ("sum", "revenue"), "rows_in_frame": ("count", "order_id"), "largest": ("max", "revenue")}
    order, by = ["bought_at", "order_id"], ["seller_id"]
    now = trailing_rows(seller_orders(t), order, by, measures, 2)
    return trailing_rows(now, order, by, {"prior_3": ("sum", "revenue")}, 3, 1).select(
        "seller_id", "order_id", money_out("last_3").alias("last_3_brl"), "rows_in_frame",
        money_out("largest").alias("largest_brl"), money_out("prior_3").alias("prior_3_brl"))


@query("w19_range_days_per_seller", SELLER_ORDERS + """
    select seller_id, order_id, round(cast(sum(revenue) over f as double), 2) as last_60_days_brl, count(*) over f as orders_60_days
    from so window f as (partition by seller_id order by cast(bought_at as date)
                         range between interval 60 day preceding and current row)""")
def w19_per_seller(t):
    orders = cut_lineage(seller_orders(t).withColumn("day", F.to_date("bought_at")))
    measures = {"last_60_days": ("sum", "revenue"), "orders_60_days": ("count", "order_id")}
    return trailing_range(orders, "day", ["seller_id"], measures, 60).select(
        "seller_id", "order_id", money_out("last_60_days").alias("last_60_days_brl"), "orders_60_days")


@query("w18_frame_without_current_row", SERIES + """
    select strftime(month, '%Y-%m') as month,
           round(cast(sum(revenue) over (order by month rows between 3 preceding and 1 preceding) as double), 2) as prior_3_brl
    from series""")
def w18(t):
    return series(t).select(
        year_month("month").alias("month"), money_out(F.sum("revenue").over(trailing("month", 3, 1))).alias("prior_3_brl"))


@query("w19_range_interval_frame", """
    with pm as (
        select person, cast(date_trunc('month', bought_at) as date) as month, sum(revenue) as revenue
        from v_order_value group by all)
    select person, strftime(month, '%Y-%m') as month,
           round(cast(sum(revenue) over f as double), 2) as sum_brl, count(*) over f as months_in_frame
    from pm window f as (partition by person order by month range between interval 2 month preceding and current row)""")
def w19(t):
    # The months of a person have gaps; one row per month bounds the partition.
    months = person_values(t).groupBy("person", month_of("bought_at").alias("month")).agg(F.sum("revenue").alias("revenue"))
    three = W.partitionBy("person").orderBy(months_index("month")).rangeBetween(-2, W.currentRow)
    return months.select(
        "person", year_month("month").alias("month"), money_out(F.sum("revenue").over(three)).alias("sum_brl"),
        F.count("*").over(three).alias("months_in_frame"))


@query("w20_rows_in_frame", SERIES + """
    select strftime(month, '%Y-%m') as month, count(*) over f as rows_in_frame,
           case when count(*) over f = 4 then round(cast(sum(revenue) over f as double), 2) end as full_sum_brl
    from series window f as (order by month rows between 3 preceding and current row)""")
def w20(t):
    four = trailing("month", 3)
    return series(t).select(
        year_month("month").alias("month"), F.count("*").over(four).alias("rows_in_frame"),
        full_frame_only(money_out(F.sum("revenue").over(four)), four, 4).alias("full_sum_brl"))


@query("w21_named_windows", SERIES + """
    select strftime(month, '%Y-%m') as month, round(cast(max(revenue) over a as double), 2) as best_3_brl,
           round(cast(min(revenue) over a as double), 2) as worst_3_brl,
           round(cast(sum(orders) over b as double), 2) as orders_6
    from series
    window a as (order by month rows between 2 preceding and current row),
           b as (order by month rows between 5 preceding and current row)""")
def w21(t):
    return t.spark.sql(
        """
        SELECT date_format(month, 'yyyy-MM') AS month,
               round(CAST(max(revenue) OVER near AS DOUBLE), 2) AS best_3_brl,
               round(CAST(min(revenue) OVER near AS DOUBLE), 2) AS worst_3_brl,
               round(CAST(sum(orders) OVER half_year AS DOUBLE), 2) AS orders_6
        FROM {monthly}
        WINDOW near AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
               half_year AS (ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
        """,
        monthly=series(t),
    )


@query("w22_window_extended_by_frame", STATE_MONTHS + """
    select state, strftime(month, '%Y-%m') as month, row_number() over w as month_number,
           round(cast(sum(revenue) over (w rows unbounded preceding) as double), 2) as upto_brl
    from sm window w as (partition by state order by month)""")
def w22(t):
    state = W.partitionBy("customer_state").orderBy("month")
    return state_months(t).select(
        F.col("customer_state").alias("state"), year_month("month").alias("month"),
        F.row_number().over(state).cast("long").alias("month_number"),
        money_out(F.sum("revenue").over(state.rowsBetween(W.unboundedPreceding, W.currentRow))).alias("upto_brl"))


@query("w23_share_of_partition", """
    select v.seller_state, s.seller_id, round(cast(s.revenue as double), 2) as revenue_brl,
           round(100.0 * cast(s.revenue as double) / cast(sum(s.revenue) over (partition by v.seller_state) as double), 1) as pct_of_state
    from (select seller_id, sum(price) as revenue from v_sold group by 1) s join v_sellers v using (seller_id)""")
def w23(t):
    return ranking.state_concentration(t)


@query("w24_days_since_previous", """
    select person, order_id, cast(cast(bought_at as date) - lag(cast(bought_at as date))
           over (partition by person order by bought_at, order_id) as bigint) as days_since_prev
    from v_order_value""")
def w24(t):
    return ordered_scan(
        person_values(t), ["bought_at", "order_id"], ["person"], number=None, previous={"previous_at": "bought_at"}
    ).select("person", "order_id", days_between("bought_at", "previous_at").alias("days_since_prev"))


@query("w25_cumulative_share", UNITS + """
    select product_id, row_number() over (order by revenue desc, product_id) as place,
           round(100.0 * cast(sum(revenue) over (order by revenue desc, product_id) as double)
                 / cast(sum(revenue) over () as double), 3) as cumulative_pct from u""")
def w25(t):
    scanned = ordered_scan(
        base.product_revenue(t), [F.desc("revenue"), "product_id"], number="place", sums={"upto": "revenue"},
        totals={"total": "revenue"})
    return scanned.select("product_id", "place", pct("upto", "total", 3).alias("cumulative_pct"))
