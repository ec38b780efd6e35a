"""The query registry and the SQL views its oracle texts stand on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..session import configure
from ..sources.tables import StarTables, open_star


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[StarTables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name`` together with its SQL."""

    def register(build):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(name, build, sql)
        return build

    return register


def runner(entry: Entry):
    def run(spark, sf_dir):
        return entry.build(open_star(configure(spark), sf_dir))

    run.__name__ = entry.name
    return run


# The marketplace views in SQL, under names that do not collide with the star schema.
VIEWS = {
    "v_customers": """
        select o_orderkey as customer_id, o_custkey as customer_unique_id,
               lpad(cast(o_custkey * 37 % 100000 as varchar), 5, '0') as customer_zip_code_prefix,
               n_name as customer_state
        from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey""",
    "v_sellers": """
        select s_suppkey as seller_id,
               lpad(cast(s_suppkey * 370 % 100000 as varchar), 5, '0') as seller_zip_code_prefix,
               n_name as seller_state
        from supplier join nation on n_nationkey = s_nationkey""",
    "v_products": """
        select p_partkey as product_id,
               case when p_size <> 50 then p_brand end as product_category_name
        from part""",
    "v_translation": """
        select distinct p_brand as product_category_name, upper(p_brand) as product_category_name_english
        from part where p_brand not in ('Brand#1', 'Brand#2')""",
    "v_orders": """
        select o_orderkey as order_id, o_orderkey as customer_id,
               case when o_orderstatus = 'F' then 'delivered' else 'other' end as order_status,
               o_orderdate as order_purchase_timestamp,
               case when o_orderkey % 97 <> 0
                    then o_orderdate + to_days(cast(o_orderkey * 7 % 45 as integer)) + to_hours(9)
               end as order_delivered_customer_date,
               o_orderdate + to_days(30) as order_estimated_delivery_date
        from orders""",
    "v_items": """
        select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
               l_suppkey as seller_id, cast(l_extendedprice as decimal(15,2)) as price,
               cast(l_quantity as decimal(15,2)) as freight_value
        from lineitem""",
    "v_payments": """
        select o_orderkey as order_id, s.n as payment_sequential,
               cast(o_totalprice as decimal(15,2)) as payment_value
        from orders join (values (1), (2)) s(n) on s.n = 1 or o_orderkey % 3 = 0
        where o_orderkey % 20 <> 0""",
    "v_reviews": """
        select event_id as review_id, event_id + s.n as order_id, 1 + (user_id + s.n) % 5 as review_score
        from events join (values (0), (1)) s(n) on s.n = 0 or event_id % 50 = 0
        where event_id + s.n in (select o_orderkey from orders)""",
    "v_geo": """
        select lpad(cast(c_custkey * 37 % 100000 as varchar), 5, '0') as zip,
               -33.0::double + (c_custkey * 13 % 380) / 10.0::double + 0.01::double * k as lat,
               -73.0::double + (c_custkey * 29 % 380) / 10.0::double - 0.01::double * k as lng
        from customer cross join range(1, 6) r(k)
        where c_custkey % 50 not in (7, 20)""",
    "v_centroid": """
        select zip, avg(lat) as lat, avg(lng) as lng, count(*) as source_rows from v_geo group by zip""",
    # Line items of delivered orders with everything the revenue reports group by.
    "v_sold": """
        select i.*, o.customer_id, o.order_purchase_timestamp as bought_at,
               o.order_delivered_customer_date as arrived_at, o.order_estimated_delivery_date as promised_at
        from v_items i join v_orders o on o.order_id = i.order_id and o.order_status = 'delivered'""",
    # The same at order grain, with the person and their place.
    "v_order_value": """
        select s.order_id, s.customer_id, s.bought_at, c.customer_unique_id as person,
               c.customer_state as state, c.customer_zip_code_prefix as zip,
               sum(s.price) as revenue, count(*) as lines
        from v_sold s join v_customers c on c.customer_id = s.customer_id
        group by all""",
    # Category label of a product, translated where the lookup knows it.
    "v_labelled": """
        select p.product_id, coalesce(t.product_category_name_english, p.product_category_name) as category
        from v_products p left join v_translation t on t.product_category_name = p.product_category_name""",
    # Revenue per calendar month.
    "v_monthly": """
        select cast(date_trunc('month', bought_at) as date) as month, sum(price) as revenue,
               count(distinct order_id) as orders
        from v_sold group by 1""",
}
_DEPENDS = {
    "v_centroid": ("v_geo",),
    "v_sold": ("v_items", "v_orders"),
    "v_order_value": ("v_sold", "v_customers"),
    "v_labelled": ("v_products", "v_translation"),
    "v_monthly": ("v_sold",),
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it names, in dependency order."""
    needed: list[str] = []

    def need(name: str) -> None:
        for parent in _DEPENDS.get(name, ()):
            need(parent)
        if name not in needed:
            needed.append(name)

    for name in VIEWS:
        if name in sql:
            need(name)
    body = sql.strip()
    if not needed:
        return body
    views = ", ".join(f"{name} as ({VIEWS[name]})" for name in needed)
    recursive = ""
    if body.lower().startswith("with recursive "):
        recursive, body = "recursive ", "with " + body[len("with recursive "):]
    if body.lower().startswith("with "):
        return f"with {recursive}{views}, {body[5:]}"
    return f"with {views} {body}"
