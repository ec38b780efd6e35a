"""Lifetime value, value segments and geographic roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import band, mean, money_out, pct
from ..operators.hierarchy import prefix_rollup, prefix_tree, with_ancestors
from ..operators.joins import grand_total
from ..sources.durable import cut_lineage
from . import base

# Labels the reports are known by.
BY_PERSON = "grouped by customer_unique_id (correct)"
BY_ROW = "grouped by customer_id (wrong)"
SEGMENTS = (
    "1. repeat, high value",
    "2. repeat, standard",
    "3. one-off, high value",
    "4. one-off, standard",
    "5. one-off, low value",
)


def order_values(t) -> DataFrame:
    """Order revenue with both identities of the buyer."""
    return base.order_revenue(t).join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")


def lifetime_values(t) -> DataFrame:
    return order_values(t).groupBy("customer_unique_id").agg(
        F.count("*").alias("orders"), F.sum("revenue").alias("lifetime_value")
    )


def lifetime_value_methods(t) -> DataFrame:
    """R-17: lifetime value per person, and per order-level id.

    Every order is counted once under each identity, so one pass over the facts
    serves both methods.
    """
    identities = F.array(
        F.struct(F.lit(BY_PERSON).alias("method"), F.col("customer_unique_id").cast("string").alias("who")),
        F.struct(F.lit(BY_ROW).alias("method"), F.col("customer_id").cast("string").alias("who")),
    )
    per_buyer = (
        order_values(t)
        .select(F.explode(identities).alias("id"), "revenue")
        .groupBy("id.method", "id.who")
        .agg(F.count("*").alias("orders"), F.sum("revenue").alias("lifetime_value"))
    )
    return per_buyer.groupBy("method").agg(
        F.count("*").alias("distinct_customers"),
        mean("lifetime_value", 2).alias("avg_ltv_brl"),
        money_out(F.max("lifetime_value")).alias("max_ltv_brl"),
        mean("orders", 3).alias("avg_orders_per_customer"),
        pct(F.count_if(F.col("orders") > 1), F.count("*"), 2).alias("pct_repeat_buyers"),
    )


def value_segments(t, high: float = 500, standard: float = 100) -> DataFrame:
    """R-18: explicit value bands, however uneven they come out."""
    repeat, value = F.col("orders") > 1, F.col("lifetime_value")
    segment = band(
        [(repeat & (value >= high), SEGMENTS[0]), (repeat, SEGMENTS[1]),
         (value >= high, SEGMENTS[2]), (value >= standard, SEGMENTS[3])],
        SEGMENTS[4],
    )
    per_segment = (
        lifetime_values(t)
        .groupBy(segment.alias("segment"))
        .agg(F.count("*").alias("customers"), F.sum("lifetime_value").alias("revenue"),
             mean("lifetime_value", 2).alias("avg_ltv_brl"))
    )
    everyone = W.partitionBy()  # a handful of segments
    return per_segment.select(
        "segment",
        "customers",
        pct("customers", F.sum("customers").over(everyone), 2).alias("pct_of_customers"),
        money_out("revenue").alias("segment_revenue_brl"),
        pct("revenue", F.sum("revenue").over(everyone), 2).alias("pct_of_revenue"),
        "avg_ltv_brl",
    ).orderBy("segment")


def zip_leaves(t) -> DataFrame:
    """Revenue and orders per zip and state: the leaves of the prefix tree."""
    places = t.customers.select(
        "customer_id", F.col("customer_zip_code_prefix").alias("zip"), F.col("customer_state").alias("state")
    )
    return (
        base.order_revenue(t).join(places, "customer_id").groupBy("zip", "state")
        .agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))
    )


def _branch(rolled: DataFrame, leaves: DataFrame, root: str) -> DataFrame:
    """One branch down to the level below ``root``; whole levels only."""
    trunk = [root[:i] for i in range(1, len(root) + 1)]
    shown = F.col("node").isin(*trunk) | ((F.col("depth") == len(root) + 1) & F.col("node").startswith(root))
    national = grand_total(leaves, F.sum("revenue"))
    return (
        rolled.filter(shown)
        .orderBy("depth", F.desc("revenue"), "node")
        .select(
            F.col("depth").cast("long").alias("depth"),
            F.col("node").alias("zip_prefix"),
            F.col("state").alias("example_state"),
            "leaf_zips",
            "orders",
            money_out("revenue").alias("revenue_brl"),
            pct("revenue", national, 2).alias("pct_of_national"),
        )
    )


def _rollup_measures():
    return {
        "revenue": F.sum("revenue"), "orders": F.sum("orders"),
        "leaf_zips": F.count_distinct("zip"), "state": F.min("state"),
    }


def zip_rollup(t, root: str = "011", depths: int = 5) -> DataFrame:
    """R-19: every leaf is added to all its prefixes in one pass."""
    leaves = cut_lineage(zip_leaves(t))
    return _branch(prefix_rollup(leaves, "zip", depths, **_rollup_measures()), leaves, root)


def zip_rollup_from_tree(t, root: str = "011", depths: int = 5) -> DataFrame:
    """R-19 the long way: build the node list level by level, then attach leaves."""
    leaves = cut_lineage(zip_leaves(t))
    tree = prefix_tree(leaves, "zip", depths)
    rolled = with_ancestors(leaves, "zip", depths).join(tree, ["depth", "node"]).groupBy("depth", "node").agg(
        *[expr.alias(name) for name, expr in _rollup_measures().items()]
    )
    return _branch(rolled, leaves, root)


def rollup_balance(t, depths: int = 5) -> DataFrame:
    """R-20: every level must sum to the same total."""
    leaves = zip_leaves(t).groupBy("zip").agg(F.sum("revenue").alias("revenue"))
    nodes = prefix_rollup(leaves, "zip", depths, revenue=F.sum("revenue"))
    return (
        nodes.groupBy("depth")
        .agg(F.count("*").alias("nodes_at_this_depth"), F.sum("revenue").alias("revenue"))
        .orderBy("depth")
        .select(F.col("depth").cast("long").alias("depth"), "nodes_at_this_depth",
                money_out("revenue").alias("total_revenue_brl"))
    )


def assert_balanced(balance: DataFrame) -> None:
    """Raise unless all levels agree."""
    totals = balance.agg(F.count_distinct("total_revenue_brl").alias("n")).first()["n"]
    if totals > 1:
        raise ValueError(f"roll-up does not balance: {totals} different totals")


def repeat_revenue_share(t) -> DataFrame:
    """R-28: people and revenue by repeat behaviour."""
    per_kind = (
        lifetime_values(t)
        .groupBy((F.col("orders") > 1).alias("is_repeat"))
        .agg(F.count("*").alias("people"), F.sum("lifetime_value").alias("revenue"))
    )
    both = W.partitionBy()
    return per_kind.select(
        "is_repeat", "people",
        money_out("revenue").alias("revenue_brl"),
        pct("people", F.sum("people").over(both), 2).alias("pct_of_people"),
        pct("revenue", F.sum("revenue").over(both), 2).alias("pct_of_revenue"),
    )
