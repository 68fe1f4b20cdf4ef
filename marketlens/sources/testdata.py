"""Adapter: derive the nine raw e-commerce inputs from the driver's tables.

The driver ships a TPC-H-like star (``orders``, ``lineitem``, ``part``,
``customer``, ``supplier``, ``nation``) plus ``documents`` / ``labels``. This
module re-expresses them as DataFrames shaped like the raw CSV inputs, so the
very same conversion jobs (``operators.etl``) run on them. Everything is lazy
DataFrame code; nothing is collected.

Mapping (value ranges checked on the test data):

=====================  ==========================================================
raw input              derived from
=====================  ==========================================================
orders                 ``orders``; status F/O/P → delivered/processing/shipped;
                       purchase = approved = ``o_orderdate``; carrier date =
                       first ``l_shipdate`` of the order; delivered date = last
                       ``l_shipdate`` when delivered; estimate = purchase + 60 d
items                  ``lineitem``; freight = price × tax
payments               ``lineitem``: type ``l_returnflag``, installments
                       ``l_quantity``, value ``l_extendedprice``, sequence
                       ``l_linenumber``
reviews                ``labels`` ⋈ ``documents``; review and order id =
                       ``doc_id``; score = 1 + 2·quality + (1 − toxic);
                       message = document text
products / categories  ``part``; category = ``p_type``, translated to lower case
customers / sellers    ``customer`` / ``supplier`` ⋈ ``nation``; ZIP prefix =
                       nation key; state = nation name
geolocation            one point per customer: ZIP = nation key,
                       lat = ⌊acctbal / 100⌋, lng = −⌊acctbal / 10⌋
=====================  ==========================================================
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Order-status codes of the test data and the names they stand for.
STATUS_NAMES = {"F": "delivered", "O": "processing", "P": "shipped"}

# Invented, deterministic estimate: purchase date + this many days.
ESTIMATE_DAYS = 60

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


@dataclass
class RawInputs:
    """The nine raw inputs of the conversion jobs, as DataFrames."""

    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    categories: DataFrame
    customers: DataFrame
    sellers: DataFrame
    geolocation: DataFrame


# Column names and types of the driver's tables (read with an
# explicit schema, so no footer has to be read to infer it).
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (a single Parquet file or directory), explicit schema."""
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def status_name_sql(code_col: str) -> str:
    whens = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in STATUS_NAMES.items())
    return f"CASE {code_col} {whens} ELSE {code_col} END"


def raw_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    t = lambda n: read_table(spark, sf_dir, n)
    orders, lineitem, part = t("orders"), t("lineitem"), t("part")
    customer, supplier, nation = t("customer"), t("supplier"), t("nation")
    documents, labels = t("documents"), t("labels")

    # Per-order shipping dates: partial aggregation keeps hot orders cheap.
    ship = (lineitem.groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
    raw_orders = orders.join(ship, orders.o_orderkey == ship.l_orderkey, "left").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        f"{status_name_sql('o_orderstatus')} AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "o_orderdate AS order_approved_at",
        "first_ship AS order_delivered_carrier_date",
        "CASE WHEN o_orderstatus = 'F' THEN last_ship END AS order_delivered_customer_date",
        f"o_orderdate + INTERVAL {ESTIMATE_DAYS} DAYS AS order_estimated_delivery_date")

    items = lineitem.selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        "l_extendedprice * l_tax AS freight_value")

    payments = lineitem.selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        "l_returnflag AS payment_type",
        "CAST(l_quantity AS INT) AS payment_installments",
        "l_extendedprice AS payment_value")

    reviews = labels.join(documents, "doc_id").selectExpr(
        "doc_id AS review_id",
        "doc_id AS order_id",
        "CAST(1 + 2 * quality + (1 - toxic) AS INT) AS review_score",
        "CAST(NULL AS STRING) AS review_comment_title",
        "text AS review_comment_message",
        "CAST(NULL AS TIMESTAMP_NTZ) AS review_creation_date",
        "CAST(NULL AS TIMESTAMP_NTZ) AS review_answer_timestamp")

    products = part.selectExpr(
        "p_partkey AS product_id",
        "p_type AS product_category_name",
        "CAST(length(p_name) AS DOUBLE) AS product_name_lenght",
        "CAST(length(concat_ws(' ', p_name, p_brand)) AS DOUBLE) AS product_description_lenght",
        "1.0D AS product_photos_qty",
        "p_size * 100.0D AS product_weight_g",
        "CAST(p_size AS DOUBLE) AS product_length_cm",
        "CAST(length(p_name) AS DOUBLE) AS product_height_cm",
        "CAST(length(p_type) AS DOUBLE) AS product_width_cm")

    categories = (part.selectExpr("p_type AS product_category_name").distinct()
                  .selectExpr("product_category_name",
                              "lower(product_category_name) AS product_category_name_english"))

    nat = nation.select("n_nationkey", "n_name")
    customers = customer.join(nat, customer.c_nationkey == nat.n_nationkey, "left").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS customer_unique_id",
        "c_nationkey AS customer_zip_code_prefix",
        "c_mktsegment AS customer_city",
        "n_name AS customer_state")

    sellers = supplier.join(nat, supplier.s_nationkey == nat.n_nationkey, "left").selectExpr(
        "s_suppkey AS seller_id",
        "s_nationkey AS seller_zip_code_prefix",
        "s_name AS seller_city",
        "n_name AS seller_state")

    geolocation = customer.selectExpr(
        "c_nationkey AS geolocation_zip_code_prefix",
        "CAST(floor(c_acctbal / 100) AS DOUBLE) AS geolocation_lat",
        "CAST(-floor(c_acctbal / 10) AS DOUBLE) AS geolocation_lng",
        "c_mktsegment AS geolocation_city",
        "CAST(NULL AS STRING) AS geolocation_state")

    return RawInputs(raw_orders, items, payments, reviews, products, categories,
                     customers, sellers, geolocation)
