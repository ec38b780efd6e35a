"""Sorts, limits, top-k and set operations (inventory groups T and U)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import money_out, pct
from ..operators.hierarchy import prefix_tree
from ..operators.topk import best_per_group, ranked_top_k, top_k, top_n_per_group, top_row_numbers
from ..plans import base, ranking
from .registry import query
from .windows import UNITS, UNITS_LABELLED, person_values, units_labelled


@query("t01_multi_key_sort", """
    select customer_state, customer_unique_id, count(*) as orders from v_customers group by all""")
def t01(t):
    counts = t.customers.groupBy("customer_state", "customer_unique_id").agg(F.count("*").alias("orders"))
    return counts.orderBy("customer_state", F.desc("orders"), F.asc_nulls_last("customer_unique_id"))


@query("t02_sort_by_hidden_column", """
    select seller_id from (select seller_id, sum(price) as revenue from v_sold group by 1) order by revenue desc, seller_id limit 25""")
def t02(t):
    return top_k(base.seller_revenue(t), 25, [F.desc("revenue"), "seller_id"]).select("seller_id")


@query("t03_sort_by_aggregate", """
    select v.seller_state, round(cast(sum(s.price) as double), 2) as revenue_brl
    from v_sold s join v_sellers v using (seller_id) group by 1 order by sum(s.price) desc""")
def t03(t):
    states = base.seller_revenue(t).join(t.sellers, "seller_id").groupBy("seller_state").agg(F.sum("revenue").alias("revenue"))
    return states.orderBy(F.desc("revenue")).select("seller_state", money_out("revenue").alias("revenue_brl"))


@query("t04_top_k", UNITS + """
    select product_id, round(cast(revenue as double), 2) as revenue_brl from u order by revenue desc, product_id limit 20""")
def t04(t):
    return top_k(base.product_revenue(t), 20, [F.desc("revenue"), "product_id"]).select(
        "product_id", money_out("revenue").alias("revenue_brl"))


@query("t04_ranked_top_k", UNITS + """
    select product_id, n as units_sold, row_number() over (order by n desc, product_id) as row_number,
           rank() over (order by n desc) as rank, dense_rank() over (order by n desc) as dense_rank
    from u qualify row_number() over (order by n desc, product_id) <= 30""")
def t04_ranked(t):
    return ranked_top_k(base.product_revenue(t), 30, "units_sold", "product_id").drop("revenue")


@query("t05_top_n_dense_rank", UNITS_LABELLED + """
    select category, product_id, n as units_sold, dense_rank() over (partition by category order by n desc) as place
    from u qualify dense_rank() over (partition by category order by n desc) <= 3""")
def t05(t):
    return top_n_per_group(units_labelled(t), "category", "units_sold", 3, "dense_rank", "place").select(
        "category", "product_id", "units_sold", "place")


@query("t06_top_n_rank", UNITS_LABELLED + """
    select category, product_id, n as units_sold, rank() over (partition by category order by n desc) as place
    from u qualify rank() over (partition by category order by n desc) <= 4""")
def t06(t):
    return top_n_per_group(units_labelled(t), "category", "units_sold", 4, "rank", "place").select(
        "category", "product_id", "units_sold", "place")


@query("t07_top_1_row_number", """
    select person, order_id, round(cast(revenue as double), 2) as order_brl from v_order_value
    qualify row_number() over (partition by person order by revenue desc, order_id) = 1""")
def t07(t):
    best = top_row_numbers(person_values(t), "person", [F.desc("revenue"), "order_id"], 1)
    return best.select("person", "order_id", money_out("revenue").alias("order_brl"))


@query("t07_top_1_by_aggregation", """
    select person, arg_min(order_id, (-revenue, order_id)) as best_order, round(cast(max(revenue) as double), 2) as order_brl,
           round(cast(sum(revenue) as double), 2) as lifetime_brl
    from v_order_value group by 1""")
def t07_aggregated(t):
    return best_per_group(person_values(t), "person", "revenue", "order_id").select(
        "person", F.col("order_id").alias("best_order"), money_out("revenue").alias("order_brl"),
        money_out("group_total").alias("lifetime_brl"))


@query("t08_both_ends", """
    select state, category, pct_of_state from (
        select c.customer_state as state, l.category,
               round(100.0 * cast(sum(s.price) as double) / cast(sum(sum(s.price)) over (partition by c.customer_state) as double), 2) as pct_of_state,
               rank() over (partition by c.customer_state order by sum(s.price) desc) as up,
               rank() over (partition by c.customer_state order by sum(s.price)) as down
        from v_sold s join v_customers c using (customer_id) join v_labelled l using (product_id)
        where l.category is not null group by c.customer_state, l.category)
    where up <= 2 or down <= 1""")
def t08(t):
    # A state has one row per category of the catalog.
    state = W.partitionBy("customer_state")
    ranked = ranking.state_category_revenue(t).select(
        F.col("customer_state").alias("state"), "category",
        pct("revenue", F.sum("revenue").over(state), 2).alias("pct_of_state"),
        F.rank().over(state.orderBy(F.desc("revenue"))).alias("up"),
        F.rank().over(state.orderBy("revenue")).alias("down"))
    return ranked.filter((F.col("up") <= 2) | (F.col("down") <= 1)).drop("up", "down")


@query("t09_top_k_entities", """
    select customer_unique_id as person, count(*) as orders from v_customers group by 1 order by 2 desc, 1 limit 10""")
def t09(t):
    counts = t.customers.groupBy(F.col("customer_unique_id").alias("person")).agg(F.count("*").alias("orders"))
    return top_k(counts, 10, [F.desc("orders"), "person"])


@query("u01_union_all", """
    select 'items' as measure, count(*) as row_count, round(cast(sum(price) as double), 2) as total_brl from v_items
    union all
    select 'payments', count(*), round(cast(sum(payment_value) as double), 2) from v_payments""")
def u01(t):
    def labelled(df, label: str, value: str):
        return df.agg(F.count("*").alias("row_count"), money_out(F.sum(value)).alias("total_brl")).select(
            F.lit(label).alias("measure"), "row_count", "total_brl")

    return labelled(t.order_items, "items", "price").unionByName(labelled(t.order_payments, "payments", "payment_value"))


NODES = """
    select distinct cast(d as bigint) as depth, left(customer_zip_code_prefix, d) as node
    from v_customers cross join (values (1), (2), (3), (4), (5)) x(d)"""


@query("u02_union_distinct_per_level", NODES)
def u02(t):
    return prefix_tree(t.customers, "customer_zip_code_prefix", 5).withColumn("depth", F.col("depth").cast("long"))
