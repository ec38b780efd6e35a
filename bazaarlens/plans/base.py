"""Building blocks shared by the reports.

Revenue is the sum of item prices, freight excluded, over delivered orders.
Facts are brought to the grain of the report before anything is joined or
ranked, so that a hot product, seller or order has shrunk to one row by then.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day, days_between, exact, month_of
from ..operators.joins import labelled, per_parent


PLACED = "order_purchase_timestamp"
# Folder of a stored order, in tables that are laid out by month.
MONTH = "order_month"
# Decimals of an average score, which is summed exactly.
SCORE_SCALE = 12


def delivered_orders(t) -> DataFrame:
    return t.delivered_orders


def placed_in(orders: DataFrame, first: str | None = None, end: str | None = None) -> Column:
    """Condition on orders placed in [first, end), given as ISO days.

    Where orders are stored by month, the months are bounded too, so that a scan
    skips the folders of all others.
    """
    placed, found = F.col(PLACED), F.lit(True)
    if first:
        found = found & (placed >= F.lit(first).cast("timestamp_ntz"))
    if end:
        found = found & (placed < F.lit(end).cast("timestamp_ntz"))
    if MONTH in orders.columns:
        if first:
            found = found & (F.col(MONTH) >= first[:7])
        if end:
            last = dt.date.fromisoformat(end) - dt.timedelta(days=1)
            found = found & (F.col(MONTH) <= f"{last:%Y-%m}")
    return found


def months_later(start: str, months: int) -> str:
    """First day of the month that many months after that of ``start``."""
    year, month = divmod(int(start[:4]) * 12 + int(start[5:7]) - 1 + months, 12)
    return f"{year:04d}-{month + 1:02d}-01"


def lateness(t) -> DataFrame:
    """Delivered orders with their lateness by calendar day.

    The promise is a day, so arriving on that day is on time. Some orders are
    marked delivered without a date; their lateness is NULL.
    """
    arrived, promised = "order_delivered_customer_date", "order_estimated_delivery_date"
    return delivered_orders(t).select(
        "order_id",
        "customer_id",
        (day(arrived) > day(promised)).alias("is_late"),
        days_between(arrived, "order_purchase_timestamp").alias("days_to_deliver"),
        days_between(arrived, promised).alias("days_vs_promise"),
    )


def dated_deliveries(t) -> DataFrame:
    """Delivered orders that state both dates."""
    return lateness(t).filter(F.col("days_vs_promise").isNotNull())


def order_sellers(t, orders: DataFrame) -> DataFrame:
    """One row per seller of each given order, with its revenue there.

    The lines meet their order first: the aggregation then reuses that
    partitioning, and AQE splits an order that holds a large part of the lines.
    """
    return (
        t.order_items.select("order_id", "seller_id", "price")
        .join(orders, "order_id")
        .groupBy("seller_id", *orders.columns)
        .agg(F.sum("price").alias("revenue"))
    )


def item_totals(t) -> DataFrame:
    """Item revenue and line count of every order."""
    return per_parent(t.order_items, "order_id", revenue=F.sum("price"), lines=F.count("*"))


def order_revenue(t, orders: DataFrame | None = None) -> DataFrame:
    """One row per delivered order that has items."""
    orders = delivered_orders(t) if orders is None else orders
    return orders.select("order_id", "customer_id", "order_purchase_timestamp").join(item_totals(t), "order_id")


def order_revenue_of(t, orders: DataFrame) -> DataFrame:
    """Revenue of a selection of orders: the selection meets the items first,
    so a small one is broadcast by AQE and the items are only scanned."""
    columns = orders.columns
    return (
        t.order_items.select("order_id", "price")
        .join(orders, "order_id")
        .groupBy(*columns)
        .agg(F.sum("price").alias("revenue"))
    )


def sold_items(t, *columns: str) -> DataFrame:
    """Line items of delivered orders, with the named item columns and the price."""
    keys = delivered_orders(t).select("order_id")
    return t.order_items.select("order_id", *columns, "price").join(keys, "order_id", "left_semi")


def product_revenue(t) -> DataFrame:
    return sold_items(t, "product_id").groupBy("product_id").agg(
        F.sum("price").alias("revenue"), F.count("*").alias("units_sold")
    )


def seller_revenue(t) -> DataFrame:
    return sold_items(t, "seller_id").groupBy("seller_id").agg(F.sum("price").alias("revenue"))


def categories(t) -> DataFrame:
    """Products that have a category, with its label."""
    named = t.products.select("product_id", "product_category_name").filter(
        F.col("product_category_name").isNotNull()
    )
    return labelled(
        named, t.translation, "product_category_name", "product_category_name_english", "category"
    ).select("product_id", "category")


def with_state(t, orders: DataFrame) -> DataFrame:
    return orders.join(t.customers.select("customer_id", "customer_state"), "customer_id")


def monthly_revenue(t, orders: DataFrame | None = None) -> DataFrame:
    """Sparse series: months without orders have no row.

    A selection of orders meets the items before they are grouped.
    """
    revenue = order_revenue(t) if orders is None else order_revenue_of(t, orders.select("order_id", PLACED))
    return (
        revenue.groupBy(month_of(PLACED).alias("month"))
        .agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))
    )


def reviews_per_order(t) -> DataFrame:
    """One score per order, an exact decimal, so orders with several reviews count once."""
    score = (exact(F.sum("review_score")) / exact(F.count("review_score"))).cast(f"decimal(30,{SCORE_SCALE})")
    return t.order_reviews.filter(F.col("review_score").isNotNull()).groupBy("order_id").agg(
        score.alias("review_score")
    )
