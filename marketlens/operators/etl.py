"""Conversion jobs: nine raw inputs → five analytical tables.

Each ``convert_*`` function is a pure DataFrame transformation; writing is
done by ``sinks.parquet.write_table`` with the layout of ``schemas.LAYOUT``.

Semantics kept from the modelled system:

* ``orders`` is item grain: one row per order item, plus one row (with NULL
  item columns) per order that has no item. Payments are aggregated per
  order and repeated on each of its item rows, so ``SUM(payment_value)``
  over ``orders`` over-counts; revenue questions use ``price``.
* ``payment_type`` is the first non-NULL type by payment sequence (ties broken
  by the remaining payment columns) — a deterministic "first".
* A payment sum over only NULL values is 0.0; NULL keys never join or group.
* ZIP prefixes are read as integers and compared as strings on both sides.
* Missing review title / message become ``''`` (so their length counts as 0).
* NaN in numeric product columns is stored as NULL.

Scale notes. Every aggregation here is algebraic (min/max/sum/count), so
Spark's partial aggregation collapses a hot key map-side before the shuffle.
Each raw input is read once, and the items once more for their keys alone. The
item join is ``items ⋈ orders`` (inner) plus ``orders ▷ items`` (anti, against
the distinct item keys) instead of one left join, because adaptive execution
never splits the outer side of a left join. The side with one row per key is
written to the shared folder first (orders with their payments, means per ZIP,
categories), so each join has two plain shuffles: adaptive execution then splits
a key of any size on the many side, and broadcasts a written side that is small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.expr import first_non_null_by, money, nan_free, nan_to_null
from marketlens.schemas import (
    CUSTOMERS_COLUMNS,
    ORDERS_COLUMNS,
    PRODUCTS_FLAT_COLUMNS,
    REVIEWS_COLUMNS,
    SELLERS_COLUMNS,
)
from marketlens.session import materialize
from marketlens.sources.testdata import RawInputs

ITEM_COLUMNS = ["order_item_id", "product_id", "seller_id", "shipping_limit_date",
                "price", "freight_value"]

# Exact view of a coordinate.
COORDINATE = "DECIMAL(28,16)"

PAYMENT_ORDER = ["payment_sequential", "payment_type", "payment_installments", "payment_value"]


def payments_per_order(payments: DataFrame) -> DataFrame:
    """One row per order: first payment type, max installments, value sum."""
    return (payments.where(F.col("order_id").isNotNull())
            .groupBy("order_id")
            .agg(first_non_null_by("payment_type", PAYMENT_ORDER).alias("payment_type"),
                 F.max("payment_installments").alias("payment_installments"),
                 F.coalesce(F.sum(money("payment_value")).cast("double"), F.lit(0.0))
                 .alias("payment_value")))


def convert_orders(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Denormalised order-item table, partitioned later by year and month."""
    head = materialize(orders.join(payments_per_order(nan_free(payments)), "order_id", "left"), "order-heads")
    # both joins deal the heads alike (null-safe, null keys of items left out): they are moved once
    own = nan_free(items.select("order_id", *ITEM_COLUMNS)).where(F.col("order_id").isNotNull())
    keys = items.where(F.col("order_id").isNotNull()).select("order_id").distinct()
    with_items = own.join(head, own["order_id"].eqNullSafe(head["order_id"])).drop(own["order_id"])
    without_items = head.join(keys, head["order_id"].eqNullSafe(keys["order_id"]), "left_anti")
    for c in ITEM_COLUMNS:
        without_items = without_items.withColumn(c, F.lit(None).cast(items.schema[c].dataType))
    wide = with_items.unionByName(without_items)
    ts = F.col("order_purchase_timestamp")
    return (wide.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
            .select(*ORDERS_COLUMNS))


def convert_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with nested ``category`` and ``dimensions`` structs."""
    p = products.join(materialize(categories, "categories"), "product_category_name", "left")
    return p.select(
        "product_id",
        F.struct(F.col("product_category_name").alias("portuguese"),
                 F.col("product_category_name_english").alias("english")).alias("category"),
        F.struct(nan_to_null("product_weight_g").alias("weight_g"),
                 nan_to_null("product_length_cm").alias("length_cm"),
                 nan_to_null("product_height_cm").alias("height_cm"),
                 nan_to_null("product_width_cm").alias("width_cm")).alias("dimensions"),
        nan_to_null("product_name_lenght").alias("product_name_length"),
        nan_to_null("product_description_lenght").alias("product_description_length"),
        nan_to_null("product_photos_qty").alias("product_photos_qty"))


def products_flat(products: DataFrame) -> DataFrame:
    """Flat view of the nested products table (struct fields → columns)."""
    return products.select(
        "product_id",
        F.col("category.portuguese").alias("category_portuguese"),
        F.col("category.english").alias("category_english"),
        F.col("dimensions.weight_g").alias("weight_g"),
        F.col("dimensions.length_cm").alias("length_cm"),
        F.col("dimensions.height_cm").alias("height_cm"),
        F.col("dimensions.width_cm").alias("width_cm"),
        "product_name_length", "product_description_length", "product_photos_qty",
    ).select(*PRODUCTS_FLAT_COLUMNS)


def geo_per_zip(geolocation: DataFrame) -> DataFrame:
    """Mean coordinates per ZIP prefix (prefix as string; NULL prefixes dropped).

    The sums are exact decimals with one division at the end, so the means do not depend on the
    order of the rows. A value that is no coordinate (infinite, or 12 digits and more) is left out
    like a missing one."""
    def mean(c: str):
        exact = F.expr(f"try_cast({c} AS {COORDINATE})")
        return (F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))).alias(c)

    return (nan_free(geolocation).where(F.col("geolocation_zip_code_prefix").isNotNull())
            .groupBy(F.col("geolocation_zip_code_prefix").cast("string")
                     .alias("geolocation_zip_code_prefix"))
            .agg(mean("geolocation_lat"), mean("geolocation_lng")))


def _with_geo(df: DataFrame, zip_col: str, geolocation: DataFrame) -> DataFrame:
    """Left join of the per-ZIP means."""
    geo = geo_per_zip(geolocation).withColumnRenamed("geolocation_zip_code_prefix", zip_col)
    left = df.withColumn(zip_col, F.col(zip_col).cast("string"))
    return left.join(materialize(geo, "zip-means"), zip_col, "left")


def convert_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    return _with_geo(customers, "customer_zip_code_prefix", geolocation).select(*CUSTOMERS_COLUMNS)


def convert_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    return _with_geo(sellers, "seller_zip_code_prefix", geolocation).select(*SELLERS_COLUMNS)


def convert_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with empty text for missing title/message; score last (partition)."""
    return (reviews.na.fill({"review_comment_title": "", "review_comment_message": ""})
            .select(*REVIEWS_COLUMNS))


def conversions(raw: RawInputs) -> dict[str, Callable[[], DataFrame]]:
    """The five conversions by table name; each may write a small side when called."""
    return {
        "orders": lambda: convert_orders(raw.orders, raw.items, raw.payments),
        "products": lambda: convert_products(raw.products, raw.categories),
        "customers": lambda: convert_customers(raw.customers, raw.geolocation),
        "reviews": lambda: convert_reviews(raw.reviews),
        "sellers": lambda: convert_sellers(raw.sellers, raw.geolocation),
    }


def convert_all(raw: RawInputs) -> dict[str, DataFrame]:
    """All five converted tables, keyed by table name."""
    return {name: make() for name, make in conversions(raw).items()}
