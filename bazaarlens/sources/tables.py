"""The marketplace tables as DataFrames, from a store or from a star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import money
from .schemas import TABLES, TableSpec

# Declared layouts of the star-schema inputs (no footer pass to infer them).
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def centroids(geolocation: DataFrame) -> DataFrame:
    """One averaged point per zip prefix, with the number of points behind it."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip")).agg(
        F.avg("geolocation_lat").alias("lat"),
        F.avg("geolocation_lng").alias("lng"),
        F.count("*").alias("source_rows"),
    )


# What a load derives from the tables and stores beside them.
DERIVED = {
    "geolocation_centroid": "zip string, lat double, lng double, source_rows long",
    "zip_distances": "customer_zip string, seller_zip string, km double",
}


class StoredTables:
    """Tables written by :func:`bazaarlens.sources.store.load_tables`: orders by
    month, customers sorted by person, centroids and distances beside them.

    ``specs`` are the declarations that the load was given.
    """

    def __init__(self, spark: SparkSession, root: str, specs: Mapping[str, TableSpec] = TABLES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = specs

    def _read(self, name: str) -> DataFrame:
        schema = T.StructType([*self.specs[name].schema.fields])
        if name == "orders":
            schema = schema.add("order_month", "string")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _derived(self, name: str) -> DataFrame:
        return self.spark.read.schema(DERIVED[name]).parquet(f"{self.root}/{name}")

    @cached_property
    def customers(self) -> DataFrame:
        return self._read("customers")

    @cached_property
    def sellers(self) -> DataFrame:
        return self._read("sellers")

    @cached_property
    def products(self) -> DataFrame:
        return self._read("products")

    @cached_property
    def translation(self) -> DataFrame:
        return self._read("product_category_translation")

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders")

    @cached_property
    def delivered_orders(self) -> DataFrame:
        return self.orders.filter(F.col("order_status") == "delivered")

    @cached_property
    def order_items(self) -> DataFrame:
        return self._read("order_items")

    @cached_property
    def order_payments(self) -> DataFrame:
        return self._read("order_payments")

    @cached_property
    def order_reviews(self) -> DataFrame:
        return self._read("order_reviews")

    @cached_property
    def geolocation(self) -> DataFrame:
        return self._read("geolocation")

    @cached_property
    def geolocation_centroid(self) -> DataFrame:
        return self._derived("geolocation_centroid")

    @cached_property
    def zip_distances(self) -> DataFrame | None:
        """km per pair of zips that occurs, where it is stored."""
        return self._derived("zip_distances")

    def by_name(self, name: str) -> DataFrame:
        return self.translation if name == "product_category_translation" else getattr(self, name)


class StarTables(StoredTables):
    """The same tables derived, column for column, from a TPC-H-like star schema.

    Each view keeps a trap of the marketplace data: one customer row per order,
    leading zeros, NULL categories, an incomplete lookup, missing delivery
    dates, several payments and reviews per order, several points per zip.
    """

    zip_distances = None

    @cached_property
    def geolocation_centroid(self) -> DataFrame:
        return centroids(self.geolocation)

    def raw(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in STAR_SCHEMAS:
            reader = reader.schema(STAR_SCHEMAS[name])
        return reader.parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        people = self.raw("customer").join(
            self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", "n_name")
        return (
            self.raw("orders")
            .join(people, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("customer_id"),
                F.col("o_custkey").alias("customer_unique_id"),
                _zip(F.col("o_custkey") * 37).alias("customer_zip_code_prefix"),
                F.col("n_name").alias("customer_state"),
            )
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return (
            self.raw("supplier")
            .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("seller_id"),
                _zip(F.col("s_suppkey") * 370).alias("seller_zip_code_prefix"),
                F.col("n_name").alias("seller_state"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_size") != 50, F.col("p_brand")).alias("product_category_name"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        return (
            self.raw("part")
            .filter(~F.col("p_brand").isin("Brand#1", "Brand#2"))
            .select(F.col("p_brand").alias("product_category_name"))
            .distinct()
            .withColumn("product_category_name_english", F.upper("product_category_name"))
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders(self.raw("orders"))

    @cached_property
    def delivered_orders(self) -> DataFrame:
        # Filtered on the stored column, so the condition reaches the scan.
        return self._orders(self.raw("orders").filter(F.col("o_orderstatus") == "F"))

    @staticmethod
    def _orders(raw: DataFrame) -> DataFrame:
        key, placed = F.col("o_orderkey"), F.col("o_orderdate")
        arrived = F.timestamp_add("HOUR", F.lit(9), F.timestamp_add("DAY", (key * 7 % 45).cast("int"), placed))
        return raw.select(
            key.alias("order_id"),
            key.alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "delivered").otherwise("other").alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            F.when(key % 97 != 0, arrived).alias("order_delivered_customer_date"),
            F.timestamp_add("DAY", F.lit(30), placed).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.items_of(self.raw("lineitem"))

    @staticmethod
    def items_of(lineitem: DataFrame) -> DataFrame:
        """Order items of some line items, stored or streamed."""
        return lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            money("l_extendedprice").alias("price"),
            money("l_quantity").alias("freight_value"),
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        rows = F.when(key % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return (
            self.raw("orders")
            .filter(key % 20 != 0)
            .select(
                key.alias("order_id"),
                F.explode(rows).alias("payment_sequential"),
                money("o_totalprice").alias("payment_value"),
            )
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        event, user = F.col("event_id"), F.col("user_id")
        shifts = F.when(event % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        own = self.raw("orders").select("o_orderkey")
        return (
            self.raw("events")
            .select(event, user, F.explode(shifts).alias("shift"))
            .select(
                event.alias("review_id"),
                (event + F.col("shift")).alias("order_id"),
                (F.lit(1) + (user + F.col("shift")) % 5).cast("int").alias("review_score"),
            )
            .join(own, F.col("order_id") == F.col("o_orderkey"), "left_semi")
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        key, k = F.col("c_custkey"), F.col("k")
        return (
            self.raw("customer")
            .filter(~(key % 50).isin(7, 20))
            .select(key, F.explode(F.array(*[F.lit(i) for i in range(1, 6)])).alias("k"))
            .select(
                _zip(key * 37).alias("geolocation_zip_code_prefix"),
                (F.lit(-33.0) + (key * 13 % 380) / F.lit(10.0) + F.lit(0.01) * k).alias("geolocation_lat"),
                (F.lit(-73.0) + (key * 29 % 380) / F.lit(10.0) - F.lit(0.01) * k).alias("geolocation_lng"),
            )
        )


def _zip(number: Column) -> Column:
    return F.lpad((number % 100000).cast("string"), 5, "0")


def open_star(spark: SparkSession, sf_dir: str) -> StarTables:
    return StarTables(spark, sf_dir)
