"""Monthly trend reports on gap-free series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import money_out, months_index, pct, quarter_of, quotient, year_month
from ..operators.series import densify, full_frame_only, month_spine, trailing
from ..sources.durable import cut_lineage
from . import base


def by_month():
    """Order of a monthly series: one row per month."""
    return W.orderBy("month")


def change_pct(now, before) -> Column:
    """Growth in percent; NULL from nothing or from zero."""
    return pct(now - before, before)


def gappy_orders(t, before: str, missing_month: str | None) -> DataFrame:
    """Early delivered orders; the test data gets its missing month here."""
    orders = base.delivered_orders(t)
    orders = orders.filter(base.placed_in(orders, end=before))
    if missing_month:
        orders = orders.filter(~base.placed_in(orders, missing_month, base.months_later(missing_month, 1)))
    return orders


def clean_series(t, first: str, last: str) -> DataFrame:
    """Every month from ``first`` to ``last``; only their orders are read."""
    spine, orders = month_spine(t.spark, first, last), base.delivered_orders(t)
    orders = orders.filter(base.placed_in(orders, f"{first[:7]}-01", base.months_later(last, 1)))
    return densify(spine, base.monthly_revenue(t, orders), {"revenue": 0, "orders": 0})


def lag_with_and_without_spine(t, before: str, first: str, last: str, missing_month: str | None = None) -> DataFrame:
    """R-06: LAG over rows against LAG over months."""
    sparse = cut_lineage(base.monthly_revenue(t, gappy_orders(t, before, missing_month)))
    naive = sparse.select(
        "month",
        F.lag("month").over(by_month()).alias("naive_prev"),
        change_pct(F.col("revenue"), F.lag("revenue").over(by_month())).alias("naive_mom_pct"),
    )
    dense = densify(month_spine(t.spark, first, last), sparse, {"revenue": 0}).select(
        "month", "revenue", change_pct(F.col("revenue"), F.lag("revenue").over(by_month())).alias("spine_mom_pct")
    )
    return (
        dense.join(naive, "month", "left")
        .orderBy("month")
        .select(
            year_month("month").alias("month"),
            money_out("revenue").alias("revenue_brl"),
            year_month("naive_prev").alias("naive_prev_month"),
            "naive_mom_pct",
            "spine_mom_pct",
        )
    )


def month_over_month(t, first: str, last: str) -> DataFrame:
    """R-07: monthly revenue, orders, average order value and growth."""
    previous = F.lag("revenue").over(by_month())
    return clean_series(t, first, last).select(
        year_month("month").alias("month"),
        money_out("revenue").alias("revenue_brl"),
        "orders",
        quotient("revenue", "orders", 2).alias("avg_order_value_brl"),
        money_out(previous).alias("prev_month_brl"),
        change_pct(F.col("revenue"), previous).alias("mom_growth_pct"),
    ).orderBy("month")


def rows_against_range(t, before: str, missing_month: str | None = None) -> DataFrame:
    """R-08: a three-row and a three-month average part ways at a gap."""
    sparse = base.monthly_revenue(t, gappy_orders(t, before, missing_month))
    rows = W.orderBy("month").rowsBetween(-2, W.currentRow)
    months = W.orderBy(months_index("month")).rangeBetween(-2, W.currentRow)
    return sparse.select(
        year_month("month").alias("month"),
        money_out("revenue").alias("revenue_brl"),
        _avg(rows).alias("ma_3mo_rows"),
        _avg(months).alias("ma_3mo_range"),
        F.count("*").over(rows).alias("rows_in_frame"),
        F.count("*").over(months).alias("range_in_frame"),
    ).orderBy("month")


def _avg(window) -> Column:
    return quotient(F.sum("revenue").over(window), F.count("revenue").over(window), 2)


def moving_averages(t, first: str, last: str) -> DataFrame:
    """R-09: averages once their frame is full, and the distance to the prior three months."""
    three, six, prior = trailing("month", 2), trailing("month", 5), trailing("month", 3, 1)
    return clean_series(t, first, last).select(
        year_month("month").alias("month"),
        money_out("revenue").alias("revenue_brl"),
        full_frame_only(_avg(three), three, 3).alias("ma_3mo"),
        full_frame_only(_avg(six), six, 6).alias("ma_6mo"),
        # Against the average of three months: three times the value against their sum.
        full_frame_only(change_pct(3 * F.col("revenue"), F.sum("revenue").over(prior)), prior, 3).alias(
            "pct_vs_prior_3mo"
        ),
    ).orderBy("month")


def year_over_year(t, first: str, last: str, shown_from: str) -> DataFrame:
    """R-10: the comparison is computed on the whole series and filtered afterwards."""
    compared = clean_series(t, first, last).select(
        "month", "revenue",
        F.lag("revenue", 12).over(by_month()).alias("last_year"),
        F.lead("revenue").over(by_month()).alias("next_month"),
    )
    return compared.filter(F.col("month") >= F.lit(shown_from).cast("date")).select(
        year_month("month").alias("month"),
        money_out("revenue").alias("revenue_brl"),
        money_out("last_year").alias("same_month_last_year_brl"),
        change_pct(F.col("revenue"), F.col("last_year")).alias("yoy_growth_pct"),
        money_out("next_month").alias("next_month_brl"),
    ).orderBy("month")


def category_momentum(t, before: str, after: str, minimum: int = 20_000, growing: int = 10, declining: int = 5) -> DataFrame:
    """R-11: categories from both ends of the change between two quarters.

    ``before`` and ``after`` are quarter starts. Only those two quarters are read.
    """
    orders = base.delivered_orders(t)

    def inside(start: str) -> Column:
        return base.placed_in(orders, start, base.months_later(start, 3))

    orders = orders.filter(inside(before) | inside(after)).select(
        "order_id", quarter_of("order_purchase_timestamp").alias("quarter")
    )
    per_product = (
        t.order_items.select("order_id", "product_id", "price").join(orders, "order_id")
        .groupBy("product_id", "quarter").agg(F.sum("price").alias("revenue"))
    )

    def revenue_in(start: str) -> Column:
        return F.sum(F.when(F.col("quarter") == F.lit(start).cast("date"), F.col("revenue")))

    change = F.col("new") - F.col("old")
    compared = (
        per_product.join(base.categories(t), "product_id").groupBy("category")
        .agg(revenue_in(before).alias("old"), revenue_in(after).alias("new"))
        .filter((F.col("old") >= minimum) & (F.col("new") >= minimum))
        .withColumn("change", change)
    )
    # One row per category of the catalog: a plain window is small here.
    ranked = compared.withColumn("growth_rank", F.rank().over(W.orderBy(F.desc("change"))).cast("long")).withColumn(
        "decline_rank", F.rank().over(W.orderBy("change"))
    )
    return (
        ranked.filter((F.col("growth_rank") <= growing) | (F.col("decline_rank") <= declining))
        .orderBy(F.desc("change"), "category")
        .select(
            F.when(F.col("change") > 0, "growing").otherwise("shrinking").alias("direction"),
            "category",
            money_out("old").alias("q2_2017_brl"),
            money_out("new").alias("q2_2018_brl"),
            money_out("change").alias("change_brl"),
            pct("change", "old").alias("yoy_pct"),
            "growth_rank",
        )
    )
