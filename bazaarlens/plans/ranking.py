"""Ranking reports: products, sellers and categories by revenue or units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import mean, money_out, pct
from ..operators.ordered import ntile
from ..operators.topk import best_per_group, ranked_top_k, share_of_group, top_k, top_n_per_group
from ..sources.durable import cut_lineage
from . import base


def short_id(column: str) -> Column:
    return F.left(F.col(column).cast("string"), F.lit(8))


def ranking_functions(t, category: str, rows: int = 8) -> DataFrame:
    """R-01: the three ranking functions side by side on ties in units sold."""
    chosen = t.products.filter(F.col("product_category_name") == category).select("product_id")
    units = base.product_revenue(t).join(chosen, "product_id", "left_semi")
    return (
        ranked_top_k(units, rows, "units_sold", "product_id")
        .select(
            short_id("product_id").alias("product"), "units_sold",
            money_out("revenue").alias("revenue_brl"), "row_number", "rank", "dense_rank",
        )
        .orderBy("row_number")
    )


def top_products_per_category(t, categories: int = 6, n: int = 5) -> DataFrame:
    """R-02: best products of the largest categories; ties may exceed ``n``."""
    products = cut_lineage(base.product_revenue(t).join(base.categories(t), "product_id"))
    totals = products.groupBy("category").agg(F.sum("revenue").alias("category_total"))
    largest = top_k(totals, categories, [F.desc("category_total"), "category"])
    # The limit bounds the broadcast to a handful of rows.
    best = top_n_per_group(products, "category", "revenue", n, "dense_rank", "revenue_rank", keep=largest)
    return (
        best.join(F.broadcast(largest), "category")
        .select(
            "category", "revenue_rank", short_id("product_id").alias("product"),
            money_out("revenue").alias("revenue_brl"), "units_sold",
            pct("revenue", "category_total").alias("pct_of_category"),
        )
        .orderBy("category", "revenue_rank", "product")
    )


def top_sellers_per_state(t, states: int = 10, n: int = 3) -> DataFrame:
    """R-03: best sellers of the largest states."""
    # Order grain first: counting its rows replaces COUNT(DISTINCT order).
    per_order = base.order_sellers(t, base.delivered_orders(t).select("order_id"))
    sellers = cut_lineage(
        per_order.groupBy("seller_id")
        .agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))
        .join(t.sellers.select("seller_id", "seller_state"), "seller_id")
    )
    totals = sellers.groupBy("seller_state").agg(F.sum("revenue").alias("state_total"))
    largest = top_k(totals, states, [F.desc("state_total"), "seller_state"])
    best = top_n_per_group(sellers, "seller_state", "revenue", n, "rank", "state_rank", keep=largest)
    return (
        best.join(F.broadcast(largest), "seller_state")
        .orderBy(F.desc("state_total"), "state_rank", "seller_id")
        .select(
            "seller_state", "state_rank", short_id("seller_id").alias("seller"),
            money_out("revenue").alias("revenue_brl"), "orders",
            pct("revenue", "state_total").alias("pct_of_state"),
        )
    )


def state_category_revenue(t) -> DataFrame:
    """Revenue per customer state and category.

    Lines shrink to (state, product) before they meet the products, so neither a
    hot product nor a hot category is ever joined row by row.
    """
    sold = t.order_items.select("order_id", "product_id", "price").join(
        base.with_state(t, base.delivered_orders(t).select("order_id", "customer_id")).select("order_id", "customer_state"),
        "order_id",
    )
    per_product = sold.groupBy("customer_state", "product_id").agg(F.sum("price").alias("revenue"))
    return (
        per_product.join(base.categories(t), "product_id")
        .groupBy("customer_state", "category")
        .agg(F.sum("revenue").alias("revenue"))
    )


def leading_category_per_state(t, states: int = 12) -> DataFrame:
    """R-04: exactly one category per state, smallest name on a tie."""
    best = best_per_group(state_category_revenue(t), "customer_state", "revenue", "category")
    return top_k(best, states, [F.desc("group_total"), "customer_state"]).select(
        "customer_state",
        F.col("category").alias("top_category"),
        money_out("revenue").alias("category_revenue_brl"),
        money_out("group_total").alias("state_revenue_brl"),
        pct("revenue", "group_total").alias("pct_of_state"),
    )


def seller_deciles(t, buckets: int = 10) -> DataFrame:
    """R-05: revenue concentration over equal-sized buckets of sellers."""
    bucketed = ntile(base.seller_revenue(t), [F.desc("revenue"), "seller_id"], buckets, "revenue_decile")
    # One row per bucket under these windows.
    running = F.sum("revenue").over(W.orderBy("revenue_decile"))
    total = F.sum("revenue").over(W.partitionBy())
    return (
        bucketed.groupBy("revenue_decile")
        .agg(F.count("*").alias("sellers"), F.sum("revenue").alias("revenue"),
             mean("revenue", 2).alias("avg_seller_revenue_brl"))
        .select(
            "revenue_decile",
            "sellers",
            money_out("revenue").alias("decile_revenue_brl"),
            pct("revenue", total).alias("pct_of_total_revenue"),
            pct(running, total).alias("cumulative_pct"),
            "avg_seller_revenue_brl",
        )
        .orderBy("revenue_decile")
    )


def state_concentration(t) -> DataFrame:
    """Share of each seller in the revenue of its state."""
    sellers = cut_lineage(base.seller_revenue(t).join(t.sellers.select("seller_id", "seller_state"), "seller_id"))
    return share_of_group(sellers, "seller_state", "revenue").select(
        "seller_state", "seller_id", money_out("revenue").alias("revenue_brl"),
        pct("revenue", "group_total").alias("pct_of_state"),
    )
