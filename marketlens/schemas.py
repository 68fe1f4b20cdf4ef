"""Schemas of the raw inputs and of the five converted tables.

Raw CSV files are always read with an explicit schema (no inference at
scale). Identifier columns are strings in the CSV files; the test-data
adapter supplies them as longs — the jobs do not depend on the id type.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, D, TS = StringType(), IntegerType(), DoubleType(), TimestampNTZType()


def _schema(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


# ---- raw inputs (nine CSV files with a header row) -------------------------
# File names and column names of the public e-commerce data set.
RAW_FILES = {
    "orders": "olist_orders_dataset.csv",
    "items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "products": "olist_products_dataset.csv",
    "categories": "product_category_name_translation.csv",
    "customers": "olist_customers_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
}

RAW_SCHEMAS = {
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS)),
    "items": _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", D), ("freight_value", D)),
    "payments": _schema(
        ("order_id", S), ("payment_sequential", I), ("payment_type", S),
        ("payment_installments", I), ("payment_value", D)),
    "reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", I),
        ("review_comment_title", S), ("review_comment_message", S),
        ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "products": _schema(
        ("product_id", S), ("product_category_name", S),
        ("product_name_lenght", D), ("product_description_lenght", D),
        ("product_photos_qty", D), ("product_weight_g", D), ("product_length_cm", D),
        ("product_height_cm", D), ("product_width_cm", D)),
    "categories": _schema(
        ("product_category_name", S), ("product_category_name_english", S)),
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", I),
        ("customer_city", S), ("customer_state", S)),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S), ("seller_state", S)),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", I), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)),
}

# ---- converted tables -------------------------------------------------------
ORDERS_COLUMNS = [
    "order_id", "customer_id", "order_status",
    "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "order_item_id", "product_id", "seller_id",
    "shipping_limit_date", "price", "freight_value",
    "payment_type", "payment_installments", "payment_value",
    "year", "month",
]

PRODUCTS_FLAT_COLUMNS = [
    "product_id", "category_portuguese", "category_english",
    "weight_g", "length_cm", "height_cm", "width_cm",
    "product_name_length", "product_description_length", "product_photos_qty",
]

CUSTOMERS_COLUMNS = [
    "customer_id", "customer_unique_id", "customer_zip_code_prefix",
    "customer_city", "customer_state", "geolocation_lat", "geolocation_lng",
]

REVIEWS_COLUMNS = [
    "review_id", "order_id", "review_comment_title", "review_comment_message",
    "review_creation_date", "review_answer_timestamp", "review_score",
]

SELLERS_COLUMNS = [
    "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
    "geolocation_lat", "geolocation_lng",
]

# Physical layout of each converted table: partition columns and codec.
LAYOUT = {
    "orders": {"partition_by": ["year", "month"], "codec": "snappy"},
    "products": {"partition_by": [], "codec": "snappy"},
    "customers": {"partition_by": [], "codec": "zstd"},
    "reviews": {"partition_by": ["review_score"], "codec": "snappy"},
    "sellers": {"partition_by": [], "codec": "snappy"},
}

TABLES = list(LAYOUT)
