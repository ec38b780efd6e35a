"""Delivery performance: lateness by place, distance, review score and seller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import band, day, haversine_km, mean, money_out, pct
from ..operators.joins import per_parent, repeated_sum, role_join, small_side
from ..operators.topk import top_k
from ..sources.durable import cut_lineage
from . import base
from .ranking import short_id

# Labels the reports are known by.
NAIVE = "WRONG: both children joined directly"
CORRECT = "CORRECT: each child pre-aggregated"
DISTANCE_BANDS = (
    (50, "a. under 50 km"),
    (200, "b. 50-200 km"),
    (500, "c. 200-500 km"),
    (1000, "d. 500-1000 km"),
)
FARTHEST = "e. over 1000 km"
UNMAPPED = "z. zip not in geolocation"
OUTCOMES = (
    "a. 10+ days early",
    "b. 1-9 days early",
    "c. on the promised day",
    "d. 1-3 days late",
    "e. 4-10 days late",
    "f. more than 10 days late",
)


def late_rate_by_state(t, minimum_orders: int = 300) -> DataFrame:
    """R-21: an order counts once per seller state, in rates and in averages."""
    per_state = (
        base.order_sellers(t, base.dated_deliveries(t).drop("customer_id"))
        .join(t.sellers.select("seller_id", "seller_state"), "seller_id")
        .drop("seller_id", "revenue")
        .distinct()
    )
    return (
        per_state.groupBy("seller_state")
        .agg(
            F.count("*").alias("orders"),
            F.count_if("is_late").alias("late_orders"),
            mean("days_to_deliver", 1).alias("avg_days_to_deliver"),
            mean("days_vs_promise", 1, where=F.col("is_late")).alias("avg_days_late"),
        )
        .filter(F.col("orders") >= minimum_orders)
        .select(
            "seller_state", "orders", "late_orders",
            pct("late_orders", "orders", 2).alias("pct_late"),
            "avg_days_to_deliver",
            "avg_days_late",
        )
        .orderBy(F.desc("pct_late"), "seller_state")
    )


def fan_out_trap(t) -> DataFrame:
    """R-22: totals of joining two children at once, and of joining them one to one."""
    items = per_parent(t.order_items, "order_id", lines=F.count("*"), items=F.sum("price"))
    payments = per_parent(t.order_payments, "order_id", payments=F.count("*"), paid=F.sum("payment_value"))
    orders = (
        base.delivered_orders(t).select("order_id").join(items, "order_id")
        # Orders without payment keep their items; an inner join has no row for them.
        .join(payments, "order_id", "left")
    )
    totals = orders.agg(
        F.sum(F.col("lines") * F.col("payments")).alias("naive_rows"),
        repeated_sum("items", "payments").alias("naive_items"),
        repeated_sum("paid", "lines").alias("naive_paid"),
        F.count("*").alias("rows"),
        F.sum("items").alias("items"),
        F.sum("paid").alias("paid"),
    )

    def labelled(label: str, rows: str, items: str, paid: str) -> Column:
        return F.struct(
            F.lit(label).alias("method"), F.col(rows).alias("row_count"),
            money_out(items).alias("item_revenue_brl"), money_out(paid).alias("payment_total_brl"),
        )

    return totals.select(F.inline(F.array(
        labelled(NAIVE, "naive_rows", "naive_items", "naive_paid"), labelled(CORRECT, "rows", "items", "paid")
    )))


def order_legs(t) -> DataFrame:
    """(order, seller) legs of dated deliveries with both zips."""
    orders = base.dated_deliveries(t).join(
        t.customers.select("customer_id", F.col("customer_zip_code_prefix").alias("customer_zip")), "customer_id"
    )
    sellers = t.sellers.select("seller_id", F.col("seller_zip_code_prefix").alias("seller_zip"))
    return base.order_sellers(t, orders.drop("customer_id")).join(sellers, "seller_id").drop("revenue")


def with_distance(df: DataFrame, centroid: DataFrame) -> DataFrame:
    """Add ``km`` between the two zips of a row; NULL when either has no centroid.

    The centroid table has one row per zip. Counted to be small, it is broadcast
    in both roles and the rows stay where they are.
    """
    points = small_side(cut_lineage(centroid.select("zip", "lat", "lng")))
    placed = role_join(df, points, "zip", [("customer_zip", "c"), ("seller_zip", "s")])
    return placed.withColumn("km", haversine_km("s_lat", "s_lng", "c_lat", "c_lng")).drop(
        "s_lat", "s_lng", "c_lat", "c_lng"
    )


def pair_distances(t) -> DataFrame:
    """Distance of every (customer zip, seller zip) pair that occurs."""
    pairs = order_legs(t).select("customer_zip", "seller_zip").distinct()
    return with_distance(pairs, t.geolocation_centroid)


def leg_distances(t) -> DataFrame:
    """Legs with their distance: looked up where the pairs are stored, else computed from centroids."""
    if t.zip_distances is None:
        return with_distance(order_legs(t), t.geolocation_centroid)
    return order_legs(t).join(t.zip_distances, ["customer_zip", "seller_zip"], "left")


def distance_band(km) -> Column:
    steps = [(km.isNull(), UNMAPPED)] + [(km < limit, label) for limit, label in DISTANCE_BANDS]
    return band(steps, FARTHEST)


def lateness_by_distance(t) -> DataFrame:
    """R-23: one row per order, at its longest leg.

    Unmapped legs are NULL and ignored by MAX, so an order is unmapped only if
    all of its legs are.
    """
    legs = leg_distances(t)
    per_order = legs.groupBy("order_id", "days_to_deliver", "is_late").agg(F.max("km").alias("km"))
    per_band = per_order.groupBy(distance_band(F.col("km")).alias("distance_band")).agg(
        F.count("*").alias("orders"), mean("days_to_deliver", 1).alias("avg_days_to_deliver"),
        F.count_if("is_late").alias("late"),
    )
    return per_band.select(
        "distance_band",
        "orders",
        # One row per band under the window.
        pct("orders", F.sum("orders").over(W.partitionBy()), 2).alias("pct_of_orders"),
        "avg_days_to_deliver",
        pct("late", "orders", 2).alias("pct_late"),
    ).orderBy("distance_band")


def delivery_outcome(days) -> Column:
    """Band of the days between promise and arrival."""
    return band(
        [(days <= -10, OUTCOMES[0]), (days < 0, OUTCOMES[1]), (days == 0, OUTCOMES[2]),
         (days <= 3, OUTCOMES[3]), (days <= 10, OUTCOMES[4])],
        OUTCOMES[5],
    )


def reviews_by_outcome(t) -> DataFrame:
    """R-24: unreviewed orders stay, in a column of their own."""
    score = F.col("review_score")
    return (
        base.dated_deliveries(t).join(base.reviews_per_order(t), "order_id", "left")
        .groupBy(delivery_outcome(F.col("days_vs_promise")).alias("delivery_outcome"))
        .agg(
            F.count("*").alias("orders"),
            F.count(score).alias("orders_reviewed"),
            mean(score, 2, scale=base.SCORE_SCALE).alias("avg_review_score"),
            F.count_if(score <= 2).alias("low"),
        )
        .orderBy("delivery_outcome")
        .select(
            "delivery_outcome", "orders", "orders_reviewed",
            (F.col("orders") - F.col("orders_reviewed")).alias("orders_not_reviewed"),
            "avg_review_score",
            pct("low", "orders_reviewed").alias("pct_scoring_1_or_2"),
        )
    )


def worst_sellers(t, minimum_orders: int = 100, rows: int = 15) -> DataFrame:
    """R-25: high-volume sellers by late rate.

    One pass at (order, seller) grain: revenue counts every delivered order,
    rates and scores only those with both dates.
    """
    pairs = base.order_sellers(t, base.lateness(t).select("order_id", "is_late")).join(
        base.reviews_per_order(t), "order_id", "left"
    )
    dated = F.col("is_late").isNotNull()
    per_seller = (
        pairs.groupBy("seller_id")
        .agg(
            F.count_if(dated).alias("orders"),
            F.count_if("is_late").alias("late_orders"),
            mean("review_score", 2, where=dated, scale=base.SCORE_SCALE).alias("avg_review_score"),
            F.sum("revenue").alias("revenue"),
        )
        .filter(F.col("orders") >= minimum_orders)
        .withColumn("pct_late", pct("late_orders", "orders"))
        .join(t.sellers.select("seller_id", "seller_state"), "seller_id")
    )
    return top_k(per_seller, rows, [F.desc("pct_late"), "seller_id"]).select(
        short_id("seller_id").alias("seller"), "seller_state", "orders", "late_orders", "pct_late",
        "avg_review_score", money_out("revenue").alias("seller_revenue_brl"),
    )


def late_by_comparison(t) -> DataFrame:
    """R-26: lateness by timestamp and by calendar day, in one pass."""
    arrived, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    dated = base.delivered_orders(t).filter(F.col(arrived).isNotNull() & F.col(promised).isNotNull())
    counts = dated.agg(
        F.count("*").alias("orders"),
        F.count_if(F.col(arrived) > F.col(promised)).alias("late_by_timestamp"),
        F.count_if(day(arrived) > day(promised)).alias("late_by_date"),
    )
    return counts.select(
        "orders", "late_by_timestamp", pct("late_by_timestamp", "orders", 2).alias("pct_by_timestamp"),
        "late_by_date", pct("late_by_date", "orders", 2).alias("pct_by_date"),
        (F.col("late_by_timestamp") - F.col("late_by_date")).alias("same_day_arrivals"),
    )


def geolocation_fan_out(t) -> DataFrame:
    """R-27: rows and revenue of joining raw points instead of centroids.

    The inflated totals are counted per zip; the inflated rows are never built.
    """
    places = t.customers.select("customer_id", F.col("customer_zip_code_prefix").alias("zip"))
    sold = (
        base.order_revenue(t).join(places, "customer_id").groupBy("zip")
        .agg(F.sum("lines").alias("rows"), F.sum("revenue").alias("revenue"))
    )
    points = t.geolocation_centroid.select("zip", "source_rows")
    totals = sold.join(points, "zip", "left").agg(
        F.sum("rows").alias("item_rows"),
        F.sum(F.when(F.col("source_rows").isNotNull(), F.col("rows"))).alias("rows_with_centroid"),
        F.sum(F.col("rows") * F.col("source_rows")).alias("rows_with_raw_points"),
        F.sum("revenue").alias("revenue"),
        repeated_sum("revenue", "source_rows").alias("raw_revenue"),
    )
    return totals.select(
        "item_rows", "rows_with_centroid", "rows_with_raw_points",
        money_out("revenue").alias("revenue_brl"),
        money_out("raw_revenue").alias("revenue_with_raw_points_brl"),
        pct("rows_with_raw_points", "rows_with_centroid").alias("raw_points_pct"),
    )


def unmapped_orders(t) -> DataFrame:
    """R-30: delivered orders whose customer or seller zip has no centroid."""
    known = small_side(cut_lineage(t.geolocation_centroid.select("zip", F.lit(True).alias("known"))))
    legs = order_legs(t).select("order_id", "customer_zip", "seller_zip")
    per_order = (
        role_join(legs, known, "zip", [("customer_zip", "c"), ("seller_zip", "s")])
        .groupBy("order_id")
        .agg(F.bool_or(F.col("c_known").isNull()).alias("customer"), F.bool_or(F.col("s_known").isNull()).alias("seller"))
    )
    return per_order.agg(F.count_if("customer").alias("customer"), F.count_if("seller").alias("seller")).unpivot(
        [], ["customer", "seller"], "side", "orders"
    )


def order_history(t, person) -> DataFrame:
    """R-29: one person's orders, a selective lookup."""
    theirs = t.customers.filter(F.col("customer_unique_id") == F.lit(person)).select("customer_id", "customer_unique_id")
    return t.orders.join(theirs, "customer_id").select(
        "customer_unique_id", "order_id", "order_status", day("order_purchase_timestamp").alias("order_date")
    )
