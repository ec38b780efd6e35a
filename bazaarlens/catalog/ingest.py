"""Scans, ingest, stored tables and checks (inventory group S).

The ingest queries write a view as CSV to the shared folder and load it back.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import money_out, month_of
from ..operators.series import month_spine_between
from ..plans import checks, discovery, ranking
from ..sources import csv_ingest, store, versions
from ..sources.durable import scratch_path
from ..sources.schemas import ORDERS, PRODUCTS, TABLES, TRANSLATION, TableSpec
from .registry import query


def view_spec(spec: TableSpec, view: DataFrame) -> TableSpec:
    """The part of a table's declaration that a view provides."""
    return replace(spec, columns=tuple(c for c in spec.columns if c[0] in view.columns))


def typed_as(spec: TableSpec, view: DataFrame) -> TableSpec:
    """The same part, with the view's types (its identifiers are numbers)."""
    return replace(spec, columns=tuple((name, view.schema[name].dataType, nullable) for name, _, nullable in view_spec(spec, view).columns))


def load_views(t, root: str) -> tuple[DataFrame, dict[str, TableSpec]]:
    """Write all views as CSV files, load them as a store, and return the row counts and the declarations."""
    views = {name: t.by_name(name) for name in TABLES}
    specs = {name: typed_as(TABLES[name], view) for name, view in views.items()}
    # Line numbers of the test data repeat within an order.
    specs["order_items"] = replace(specs["order_items"], key=())
    paths = {name: scratch_path(t.spark, f"{name}-csv") for name in views}

    def export(name: str) -> None:
        spec = specs[name]
        export_csv(views[name].select(*[F.col(c).alias(spec.header_of(c)) for c, _, _ in spec.columns]), paths[name])

    store.at_once(t.spark, export, views)
    return store.load_tables(t.spark, paths, root, specs=specs), specs


def export_csv(df: DataFrame, path: str) -> str:
    (
        df.write.option("header", True).option("quote", '"').option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


@query("s01_csv_typed_scan", """
    select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id, order_status,
           order_purchase_timestamp, order_delivered_customer_date, order_estimated_delivery_date
    from v_orders""")
def s01(t):
    path = export_csv(t.orders, scratch_path(t.spark, "orders-csv"))
    return csv_ingest.read_table_csv(t.spark, view_spec(ORDERS, t.orders), path)


DOCUMENT = TableSpec("documents", (("doc_id", T.LongType(), False), ("text", T.StringType(), True)), key=("doc_id",))


@query("s02_csv_quoted_text", """
    select cast(doc_id as bigint) as doc_id, cast(length(text) as bigint) as characters, md5(text) as digest,
           cast(length(text) - length(replace(text, chr(10), '')) as bigint) as newlines,
           cast(length(text) - length(replace(text, '"', '')) as bigint) as quotes
    from documents""")
def s02(t):
    path = export_csv(t.raw("documents").select("doc_id", "text"), scratch_path(t.spark, "documents-csv"))
    text = F.col("text")

    def occurrences(needle: str):
        return (F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))).cast("long")

    return csv_ingest.read_table_csv(t.spark, DOCUMENT, path, multi_line=True).select(
        "doc_id", F.length(text).cast("long").alias("characters"), F.md5(text).alias("digest"),
        occurrences("\n").alias("newlines"), occurrences('"').alias("quotes"),
    )


@query("s03_csv_required_header", """
    select 'order_status' as missing_column, count(*) as row_count from v_orders""")
def s03(t):
    path = export_csv(t.orders.drop("order_status"), scratch_path(t.spark, "headless-csv"))
    df = csv_ingest.read_text_csv(t.spark, path)
    missing = csv_ingest.missing_columns(df, view_spec(ORDERS, t.orders))
    return df.agg(F.count("*").alias("row_count")).select(F.lit(", ".join(missing)).alias("missing_column"), "row_count")


@query("s04_csv_renamed_headers", """
    select cast(p_partkey as varchar) as product_id, cast(length(p_name) as smallint) as product_name_length,
           cast(p_size as integer) as product_weight_g
    from part""")
def s04(t):
    # The file misspells a header and holds the columns in another order.
    misspelt = t.raw("part").select(
        F.col("p_size").alias("product_weight_g"),
        F.length("p_name").alias(PRODUCTS.header_of("product_name_length")),
        F.col("p_partkey").alias("product_id"),
    )
    wanted = ("product_id", "product_name_length", "product_weight_g")
    spec = replace(PRODUCTS, columns=tuple(c for c in PRODUCTS.columns if c[0] in wanted))
    return csv_ingest.read_table_csv(t.spark, spec, export_csv(misspelt, scratch_path(t.spark, "products-csv")))


@query("s05_csv_empty_to_null", """
    select cast(product_id as varchar) as product_id, product_category_name from v_products""")
def s05(t):
    path = export_csv(t.products.fillna("", ["product_category_name"]), scratch_path(t.spark, "empty-csv"))
    return csv_ingest.read_table_csv(t.spark, view_spec(PRODUCTS, t.products), path)


@query("s06_csv_byte_order_mark", "select * from v_translation")
def s06(t):
    marked = t.translation.withColumnRenamed("product_category_name", "\ufeffproduct_category_name")
    path = export_csv(marked, scratch_path(t.spark, "bom-csv"))
    return csv_ingest.read_table_csv(t.spark, TRANSLATION, path)


@query("s07_load_all_tables", """
    with c as (
        select 'customers' as table_name, count(*) as row_count from v_customers
        union all select 'sellers', count(*) from v_sellers
        union all select 'product_category_translation', count(*) from v_translation
        union all select 'products', count(*) from v_products
        union all select 'orders', count(*) from v_orders
        union all select 'order_items', count(*) from v_items
        union all select 'order_payments', count(*) from v_payments
        union all select 'order_reviews', count(*) from v_reviews
        union all select 'geolocation', count(*) from v_geo)
    select * from c union all select 'TOTAL', cast(sum(row_count) as bigint) from c""")
def s07(t):
    return load_views(t, scratch_path(t.spark, "store"))[0]


@query("s08_base_table_scan", """
    select order_id, seller_id, cast(price as double) as price_brl from v_items where price >= 90000""")
def s08(t):
    costly = t.order_items.filter(F.col("price") >= 90000)
    return costly.select("order_id", "seller_id", money_out("price").alias("price_brl"))


@query("s09_month_series", """
    select cast(g.m as date) as month
    from (select min(date_trunc('month', o_orderdate)) as a, max(date_trunc('month', o_orderdate)) as b from orders) x,
         generate_series(cast(x.a as timestamp), cast(x.b as timestamp), interval 1 month) g(m)""")
def s09(t):
    placed = month_of("order_purchase_timestamp")
    bounds = t.orders.agg(F.min(placed).alias("a"), F.max(placed).alias("b"))
    return month_spine_between(bounds, F.col("a"), F.col("b"))


CENTROIDS = "select zip, round(lat, 6) as lat, round(lng, 6) as lng, source_rows from v_centroid"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("zip", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "source_rows")


@query("s10_materialized_centroids", CENTROIDS)
def s10(t):
    return _rounded(store.refresh_centroids(t.spark, t.geolocation, scratch_path(t.spark, "centroid")))


@query("s11_refreshed_centroids", CENTROIDS)
def s11(t):
    # The first build sees half of each zip's points; the refresh sees them all.
    root = scratch_path(t.spark, "centroid")
    stale = t.geolocation.filter(F.col("geolocation_lat") < -20)
    store.refresh_centroids(t.spark, stale, root)
    return _rounded(store.refresh_centroids(t.spark, t.geolocation, root))


@query("s12_row_count_check", """
    select 'row count' as check_name, subject, cast(expected as varchar) as expected, actual, expected = actual as ok
    from (select 'customers' as subject, (select count(*) from orders) as expected, (select count(*) from v_customers) as actual
          union all select 'order_items', (select count(*) from lineitem), (select count(*) from v_items)
          union all select 'products', (select count(*) from part), (select count(*) from v_products)
          union all select 'sellers', (select count(*) from supplier), (select count(*) from v_sellers)
          union all select 'order_payments', (select count(*) from orders), (select count(*) from v_payments)
          union all select 'orders', (select count(*) from orders), (select count(*) from v_orders)
          union all select 'order_reviews', (select count(*) from events), (select count(*) from v_reviews)
          union all select 'product_category_translation', (select count(*) from part), (select count(*) from v_translation)
          union all select 'geolocation', (select count(*) from customer), (select count(*) from v_geo))""")
def s12(t):
    source = {"customers": "orders", "order_items": "lineitem", "products": "part", "sellers": "supplier",
              "order_payments": "orders", "orders": "orders", "order_reviews": "events",
              "product_category_translation": "part", "geolocation": "customer"}
    expected = {name: t.raw(raw).agg(F.count("*")).scalar() for name, raw in source.items()}
    return checks.row_counts({name: t.by_name(name) for name in source}, expected)


@query("s13_integrity_spot_checks", """
    select 'spot check' as check_name, subject, expected, actual, ok from (
        select 'zips with a leading zero' as subject, '> 0' as expected,
               (select count(*) from v_customers where customer_zip_code_prefix like '0%') as actual, true as ok
        union all select 'products without category', '> 0', (select count(*) from v_products where product_category_name is null), true
        union all select 'orders without delivery date', '> 0', (select count(*) from v_orders where order_delivered_customer_date is null), true
        union all select 'distinct people', '> 0', (select count(distinct customer_unique_id) from v_customers), true
        union all select 'categories without translation', '2', (
            select count(distinct product_category_name) from v_products
            where product_category_name not in (select product_category_name from v_translation)), true)""")
def s13(t):
    return checks.spot_checks(t, untranslated=2)


KEYED = ("customers", "sellers", "product_category_translation", "products", "orders", "order_items",
         "order_payments", "order_reviews")


def _dup_sql(name: str, view: str) -> str:
    key = ", ".join(TABLES[name].key)
    return f"""select 'unique key' as check_name, '{name}({key})' as subject, '0' as expected, count(*) as actual,
        count(*) = 0 as ok from (select {key} from {view} group by all having count(*) > 1)"""


@query("s14_uniqueness_check", " union all ".join(
    _dup_sql(name, view) for name, view in zip(KEYED, (
        "v_customers", "v_sellers", "v_translation", "v_products", "v_orders", "v_items", "v_payments", "v_reviews"))))
def s14(t):
    return checks.uniqueness({n: t.by_name(n) for n in KEYED}, {n: TABLES[n].key for n in KEYED})


@query("s15_reference_check", """
    select 'reference' as check_name, subject, '0' as expected, actual, actual = 0 as ok from (
        select 'orders.customer_id -> customers.customer_id' as subject,
               (select count(*) from v_orders where customer_id not in (select customer_id from v_customers)) as actual
        union all select 'order_items.order_id -> orders.order_id',
               (select count(*) from v_items where order_id not in (select order_id from v_orders))
        union all select 'order_items.product_id -> products.product_id',
               (select count(*) from v_items where product_id not in (select product_id from v_products))
        union all select 'order_items.seller_id -> sellers.seller_id',
               (select count(*) from v_items where seller_id not in (select seller_id from v_sellers))
        union all select 'order_payments.order_id -> orders.order_id',
               (select count(*) from v_payments where order_id not in (select order_id from v_orders))
        union all select 'order_reviews.order_id -> orders.order_id',
               (select count(*) from v_reviews where order_id not in (select order_id from v_orders)))""")
def s15(t):
    names = ("customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews")
    return checks.references({n: t.by_name(n) for n in names})


# The required columns that the views have, and one that may be empty.
NEVER_NULL = {
    "customers": ("v_customers", ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state")),
    "sellers": ("v_sellers", ("seller_id", "seller_zip_code_prefix", "seller_state")),
    "product_category_translation": ("v_translation", ("product_category_name", "product_category_name_english")),
    "products": ("v_products", ("product_id",)),
    "orders": ("v_orders", ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                            "order_estimated_delivery_date", "order_delivered_customer_date")),
    "order_items": ("v_items", ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")),
    "order_payments": ("v_payments", ("order_id", "payment_sequential", "payment_value")),
    "order_reviews": ("v_reviews", ("review_id", "order_id", "review_score")),
}


def _null_sql(name: str, view: str, columns) -> str:
    return " union all ".join(
        f"""select 'not null' as check_name, '{name}.{c}' as subject, '0' as expected, count(*) filter ({c} is null) as actual,
        count(*) filter ({c} is null) = 0 as ok from {view}""" for c in columns)


@query("s16_null_and_range_check", " union all ".join(_null_sql(n, *x) for n, x in NEVER_NULL.items()) + """
    union all
    select 'check', 'review_score between 1 and 5', '0', count(*) filter (review_score not between 1 and 5),
           count(*) filter (review_score not between 1 and 5) = 0 from v_reviews""")
def s16(t):
    nulls = [checks.null_counts(name, t.by_name(name), columns) for name, (_, columns) in NEVER_NULL.items()]
    return reduce(DataFrame.unionByName, [*nulls, checks.score_range(t.order_reviews)])


@query("s17_column_statistics", """
    select 'o_orderkey' as column_name, cast(min(o_orderkey) as varchar) as min_value,
           cast(max(o_orderkey) as varchar) as max_value, count(*) - count(o_orderkey) as null_count from orders
    union all
    select 'o_custkey', cast(min(o_custkey) as varchar), cast(max(o_custkey) as varchar), count(*) - count(o_custkey) from orders""")
def s17(t):
    path = scratch_path(t.spark, "analyzed")
    name = "analyzed_" + path.rsplit("-", 1)[1]
    return store.analyzed_table(t.raw("orders").select("o_orderkey", "o_custkey"), name, path)


@query("s18_data_profile", """
    select table_name, n as row_count, d as distinct_rows, n - d as surplus_copies from (
        select 'geolocation' as table_name, count(*) as n, (select count(*) from (select distinct * from v_geo)) as d from v_geo
        union all
        select 'order_items', count(*), (select count(*) from (select distinct order_id, order_item_id from v_items)) from v_items)""")
def s18(t):
    return checks.profile("geolocation", t.geolocation).unionByName(
        checks.profile("order_items", t.order_items.select("order_id", "order_item_id"))
    )


# Columns that are profiled and searched for keys: those without fractions, whose text is the same everywhere.
DESCRIBED = {
    "sellers": ("v_sellers", ("seller_id", "seller_zip_code_prefix", "seller_state")),
    "product_category_translation": ("v_translation", ("product_category_name", "product_category_name_english")),
    "products": ("v_products", ("product_id", "product_category_name")),
    "orders": ("v_orders", ("order_id", "customer_id", "order_status")),
    "order_items": ("v_items", ("order_id", "order_item_id", "product_id", "seller_id")),
    "order_payments": ("v_payments", ("order_id", "payment_sequential")),
    "order_reviews": ("v_reviews", ("review_id", "order_id", "review_score")),
}


@query("s18_column_profile", " union all ".join(
    f"""select '{name}' as table_name, '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
        cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value from {view}"""
    for name, (view, columns) in DESCRIBED.items() for c in columns))
def s18_columns(t):
    return reduce(DataFrame.unionByName, [
        discovery.column_profile(name, t.by_name(name).select(*columns)).select(
            "table_name", "column_name", "row_count", "null_count", "min_value", "max_value")
        for name, (_, columns) in DESCRIBED.items()])


def _sets_sql(name: str, view: str, columns) -> str:
    sets = [s for n in range(1, len(columns) + 1) for s in combinations(columns, n)]
    return " union all ".join(
        f"""select '{name}' as table_name, '{",".join(s)}' as key_columns, {sum(1 << columns.index(c) for c in s)} as mask,
        (select count(*) from (select distinct {", ".join(s)} from {view})) = count(*)
        and {" and ".join(f"count({c}) = count(*)" for c in s)} as identifies from {view}""" for s in sets)


@query("s14_minimal_keys", f"""
    with sets as ({" union all ".join(_sets_sql(n, *x) for n, x in DESCRIBED.items())})
    select table_name, key_columns from sets s where identifies and not exists (
        select 1 from sets p where p.table_name = s.table_name and p.identifies and p.mask <> s.mask and (p.mask & s.mask) = p.mask)""")
def s14_keys(t):
    found = [(name, ",".join(key)) for name, (_, columns) in DESCRIBED.items()
             for key in discovery.minimal_keys(t.by_name(name).select(*columns))]
    return t.spark.createDataFrame(found, "table_name string, key_columns string")


@query("s18_time_of_day", """
    select 'promised' as stamp, count(*) filter (hour(ts) + minute(ts) + second(ts) = 0) as midnight,
           count(*) filter (hour(ts) + minute(ts) + second(ts) <> 0) as with_time
    from (select order_estimated_delivery_date as ts from v_orders)
    union all
    select 'arrived', count(*) filter (hour(ts) + minute(ts) + second(ts) = 0),
           count(*) filter (hour(ts) + minute(ts) + second(ts) <> 0)
    from (select order_delivered_customer_date as ts from v_orders)""")
def s18_time(t):
    stamps = {"promised": "order_estimated_delivery_date", "arrived": "order_delivered_customer_date"}
    return reduce(DataFrame.unionByName, [
        checks.time_of_day(t.orders, column).select(F.lit(label).alias("stamp"), "midnight", "with_time")
        for label, column in stamps.items()
    ])


@query("s19_version_difference", """
    select 'inserted' as change, count(*) as orders, cast(sum(order_id) as bigint) as ids from v_orders where order_id % 11 = 0
    union all select 'removed', count(*), cast(sum(order_id) as bigint) from v_orders where order_id % 13 = 0 and order_id % 11 <> 0
    union all select 'changed', count(*), cast(sum(order_id) as bigint) from v_orders
    where order_id % 17 = 0 and order_id % 11 <> 0 and order_id % 13 <> 0""")
def s19_difference(t):
    # Two stored versions: orders that came, that went, and that got another state.
    key, old, new = F.col("order_id"), scratch_path(t.spark, "version"), scratch_path(t.spark, "version")
    versions.write_version(t.orders.filter(key % 11 != 0), ["order_id"], old, 32)
    state = F.when(key % 17 == 0, "returned").otherwise(F.col("order_status"))
    versions.write_version(t.orders.filter((key % 13 != 0) | (key % 11 == 0)).withColumn("order_status", state), ["order_id"], new, 32)
    found = versions.difference(t.spark, old, new, t.orders.schema, ["order_id"])
    return found.groupBy("change").agg(F.count("*").alias("orders"), F.sum("order_id").alias("ids"))


@query("s19_reproducibility_check", """
    select count(distinct seller_id) as first_rows, count(distinct seller_id) as second_rows, true as equal from v_sold""")
def s19(t):
    return checks.same_result(ranking.state_concentration(t), ranking.state_concentration(t))
