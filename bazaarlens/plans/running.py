"""Running totals, cumulative shares and first/last values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import day, days_between, money_out, month_of, pct, year_month
from ..operators.ordered import ordered_scan, pareto
from ..operators.skew import join_per_key
from ..operators.topk import top_k
from ..sources.durable import cut_lineage
from . import base
from .ranking import short_id


def person_orders(t) -> DataFrame:
    """Delivered orders with the person behind each customer row."""
    orders = base.delivered_orders(t).select("order_id", "customer_id", "order_purchase_timestamp")
    people = t.customers.select("customer_id", F.col("customer_unique_id").alias("person"))
    return orders.join(people, "customer_id").drop("customer_id")


def most_frequent_person(placed: DataFrame) -> DataFrame:
    """The person with most of the given orders, smallest id on a tie (one row)."""
    counts = placed.groupBy("person").agg(F.count("*").alias("orders"))
    return top_k(counts, 1, [F.desc("orders"), "person"]).select("person")


def frames_on_ties(t, person: DataFrame | None = None, unit: str = "DAY") -> DataFrame:
    """R-12: default frame, ROWS frame and unique order for one person's orders.

    One person may own a large part of all orders, so the running totals come
    from the distributed scan. Among tied dates a ROWS frame may use any order;
    here it uses the order id.
    """
    placed = cut_lineage(person_orders(t)) if person is None else person_orders(t)
    person = most_frequent_person(placed) if person is None else person
    chosen = placed.join(F.broadcast(person.limit(1)), "person", "left_semi")
    orders = base.order_revenue_of(t, chosen.select("order_id", "order_purchase_timestamp")).select(
        "order_id",
        F.to_date(F.date_trunc(unit, "order_purchase_timestamp")).alias("order_date"),
        "revenue",
    )
    scanned = ordered_scan(orders, ["order_date", "order_id"], number="place", sums={"running": "revenue"})
    # Rows of a date share the total reached by the last of them.
    per_date = scanned.groupBy("order_date").agg(
        F.max_by("running", "place").alias("with_peers"), F.count("*").alias("orders_that_day")
    )
    return (
        join_per_key(scanned, per_date, ["order_date"], "orders_that_day")
        .orderBy("order_date", "order_id")
        .select(
            short_id("order_id").alias("order_ref"),
            "order_date",
            money_out("revenue").alias("order_brl"),
            money_out("with_peers").alias("default_frame_range"),
            money_out("running").alias("explicit_rows"),
            money_out("running").alias("unique_order_by"),
        )
    )


def repeat_customer_spend(t, people: int = 3, minimum_orders: int = 5) -> DataFrame:
    """R-13: cumulative spend of the most frequent repeat customers."""
    # Orders with their revenue and person, written once: both the choice and the spend read them.
    revenue = cut_lineage(person_orders(t).join(base.item_totals(t).select("order_id", "revenue"), "order_id"))
    counts = revenue.groupBy("person").agg(F.count("*").alias("orders")).filter(F.col("orders") >= minimum_orders)
    # At most ``people`` rows, so the broadcast is bounded.
    chosen = top_k(counts, people, [F.desc("orders"), "person"]).select("person")
    orders = revenue.join(F.broadcast(chosen), "person")
    scanned = ordered_scan(
        orders, ["order_purchase_timestamp", "order_id"], by=["person"], number="order_seq",
        sums={"cumulative": "revenue"}, previous={"previous_at": "order_purchase_timestamp"},
    )
    lifetime = scanned.groupBy("person").agg(F.sum("revenue").alias("lifetime"))
    return (
        scanned.join(F.broadcast(lifetime), "person")
        .orderBy("person", "order_seq")
        .select(
            short_id("person").alias("customer"),
            "order_seq",
            day("order_purchase_timestamp").alias("order_date"),
            money_out("revenue").alias("order_brl"),
            money_out("cumulative").alias("cumulative_brl"),
            days_between("order_purchase_timestamp", "previous_at").alias("days_since_prev"),
            pct("revenue", "lifetime").alias("pct_of_lifetime"),
        )
    )


def state_months(t, first: str, end: str, states: Sequence[str] | None = None) -> DataFrame:
    """Revenue per state and month, orders placed in [first, end)."""
    orders = base.delivered_orders(t)
    orders = base.with_state(t, orders.filter(base.placed_in(orders, first, end)))
    if states is not None:
        orders = orders.filter(F.col("customer_state").isin(*states))
    per_order = base.order_revenue_of(t, orders.select(
        "order_id", "customer_state", month_of("order_purchase_timestamp").alias("month")))
    return per_order.groupBy("customer_state", "month").agg(F.sum("revenue").alias("revenue"))


def cumulative_by_state(t, first: str, end: str, states: Sequence[str]) -> DataFrame:
    """R-14: revenue accumulating month by month, and its share of the state."""
    # A state has one row per month, so its window is bounded by the calendar.
    state = W.partitionBy("customer_state")
    running = F.sum("revenue").over(state.orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        state_months(t, first, end, states)
        .select("customer_state", "month", "revenue", running.alias("running"),
                F.sum("revenue").over(state).alias("state_total"))
        .orderBy("customer_state", "month")
        .select(
            "customer_state",
            year_month("month").alias("month"),
            money_out("revenue").alias("month_brl"),
            money_out("running").alias("cumulative_brl"),
            pct("running", "state_total").alias("pct_of_state_total"),
        )
    )


def pareto_sellers(t, thresholds: Sequence[float] = (25, 50, 80, 90, 99)) -> DataFrame:
    """R-15: how many sellers it takes to reach each share of revenue."""
    return (
        pareto(base.seller_revenue(t), "revenue", "seller_id", thresholds)
        .select(
            F.col("position").alias("sellers_needed"),
            pct("position", "members").alias("pct_of_all_sellers"),
            money_out("revenue").alias("this_seller_brl"),
            F.col("cumulative_pct").alias("cumulative_revenue_pct"),
        )
        .orderBy("sellers_needed")
    )


def first_and_last_values(t, first: str, end: str, states: Sequence[str]) -> DataFrame:
    """R-16: LAST_VALUE echoes its row under the default frame."""
    state = W.partitionBy("customer_state")
    best_first = state.orderBy(F.desc("revenue"))
    whole = best_first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (
        state_months(t, first, end, states)
        .select(
            "customer_state", "month", "revenue",
            F.first_value("revenue").over(best_first).alias("best"),
            F.last_value("revenue").over(best_first).alias("echo"),
            F.last_value("revenue").over(whole).alias("worst"),
            F.min("revenue").over(state).alias("smallest"),
        )
        .orderBy("customer_state", F.desc("revenue"))
        .select(
            "customer_state",
            year_month("month").alias("month"),
            money_out("revenue").alias("month_brl"),
            money_out("best").alias("best_month_brl"),
            money_out("echo").alias("worst_month_broken"),
            money_out("worst").alias("worst_month_fixed"),
            money_out("smallest").alias("worst_month_via_min"),
        )
    )
