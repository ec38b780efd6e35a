"""Declared schemas, keys and relations of the nine marketplace tables.

Types are stated, never inferred: identifiers and zip prefixes are strings (a
zip keeps its leading zeros), amounts are exact decimals, timestamps carry no
time zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, SHORT, INT = T.StringType(), T.ShortType(), T.IntegerType()
STAMP, PRICE, REAL = T.TimestampNTZType(), T.DecimalType(10, 2), T.DoubleType()


@dataclass(frozen=True)
class TableSpec:
    """One table: typed columns, and where its CSV differs from it."""

    name: str
    columns: tuple[tuple[str, T.DataType, bool], ...]
    key: tuple[str, ...] = ()
    headers: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(name, dtype, True, {"comment": f"{self.name}.{name}"})
            for name, dtype, _ in self.columns
        ])

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that may not be NULL."""
        return tuple(name for name, _, nullable in self.columns if not nullable)

    def header_of(self, column: str) -> str:
        return self.headers.get(column, column)


@dataclass(frozen=True)
class Relation:
    """Every ``child.column`` value must exist in ``parent.parent_column``."""

    child: str
    column: str
    parent: str
    parent_column: str


CUSTOMERS = TableSpec(
    "customers",
    (("customer_id", TEXT, False), ("customer_unique_id", TEXT, False),
     ("customer_zip_code_prefix", TEXT, False), ("customer_city", TEXT, False),
     ("customer_state", TEXT, False)),
    key=("customer_id",),
)
SELLERS = TableSpec(
    "sellers",
    (("seller_id", TEXT, False), ("seller_zip_code_prefix", TEXT, False),
     ("seller_city", TEXT, False), ("seller_state", TEXT, False)),
    key=("seller_id",),
)
TRANSLATION = TableSpec(
    "product_category_translation",
    (("product_category_name", TEXT, False), ("product_category_name_english", TEXT, False)),
    key=("product_category_name",),
)
PRODUCTS = TableSpec(
    "products",
    (("product_id", TEXT, False), ("product_category_name", TEXT, True),
     ("product_name_length", SHORT, True), ("product_description_length", INT, True),
     ("product_photos_qty", SHORT, True), ("product_weight_g", INT, True),
     ("product_length_cm", INT, True), ("product_height_cm", INT, True),
     ("product_width_cm", INT, True)),
    key=("product_id",),
    # The two headers the published CSV misspells.
    headers={"product_name_length": "product_name_lenght",
             "product_description_length": "product_description_lenght"},
)
ORDERS = TableSpec(
    "orders",
    (("order_id", TEXT, False), ("customer_id", TEXT, False), ("order_status", TEXT, False),
     ("order_purchase_timestamp", STAMP, False), ("order_approved_at", STAMP, True),
     ("order_delivered_carrier_date", STAMP, True), ("order_delivered_customer_date", STAMP, True),
     ("order_estimated_delivery_date", STAMP, True)),
    key=("order_id",),
)
ORDER_ITEMS = TableSpec(
    "order_items",
    (("order_id", TEXT, False), ("order_item_id", SHORT, False), ("product_id", TEXT, False),
     ("seller_id", TEXT, False), ("shipping_limit_date", STAMP, False), ("price", PRICE, False),
     ("freight_value", PRICE, False)),
    key=("order_id", "order_item_id"),
)
ORDER_PAYMENTS = TableSpec(
    "order_payments",
    (("order_id", TEXT, False), ("payment_sequential", SHORT, False), ("payment_type", TEXT, False),
     ("payment_installments", SHORT, False), ("payment_value", PRICE, False)),
    key=("order_id", "payment_sequential"),
)
ORDER_REVIEWS = TableSpec(
    "order_reviews",
    (("review_id", TEXT, False), ("order_id", TEXT, False), ("review_score", SHORT, False),
     ("review_comment_title", TEXT, True), ("review_comment_message", TEXT, True),
     ("review_creation_date", STAMP, False), ("review_answer_timestamp", STAMP, False)),
    key=("review_id", "order_id"),
)
GEOLOCATION = TableSpec(
    "geolocation",
    (("geolocation_zip_code_prefix", TEXT, False), ("geolocation_lat", REAL, False),
     ("geolocation_lng", REAL, False), ("geolocation_city", TEXT, False),
     ("geolocation_state", TEXT, False)),
)

# Parents before children.
TABLES = {
    spec.name: spec
    for spec in (CUSTOMERS, SELLERS, TRANSLATION, PRODUCTS, ORDERS, ORDER_ITEMS,
                 ORDER_PAYMENTS, ORDER_REVIEWS, GEOLOCATION)
}

RELATIONS = (
    Relation("orders", "customer_id", "customers", "customer_id"),
    Relation("order_items", "order_id", "orders", "order_id"),
    Relation("order_items", "product_id", "products", "product_id"),
    Relation("order_items", "seller_id", "sellers", "seller_id"),
    Relation("order_payments", "order_id", "orders", "order_id"),
    Relation("order_reviews", "order_id", "orders", "order_id"),
)

SCORE_RANGE = (1, 5)

# Row counts of the published data set.
PUBLISHED_ROWS = {
    "customers": 99_441,
    "geolocation": 1_000_163,
    "order_items": 112_650,
    "order_payments": 103_886,
    "order_reviews": 99_224,
    "orders": 99_441,
    "products": 32_951,
    "sellers": 3_095,
    "product_category_translation": 71,
}
