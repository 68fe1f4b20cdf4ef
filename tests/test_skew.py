"""Hot keys: one order holding a third of all item rows.

With broadcasts disabled (as for large tables), adaptive execution must split
the hot order across tasks in the conversion's item join, and the result must
still be exact and whole.
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.operators.etl import convert_customers, convert_orders, convert_products

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _inputs(spark, n_orders=600, hot_items=6000):
    ts = dt.datetime(2017, 1, 1)
    orders = spark.range(n_orders).select(
        F.col("id").alias("order_id"), (F.col("id") % 50).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit(ts).cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(ts).cast("timestamp_ntz").alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit(None).cast("timestamp_ntz").alias("order_estimated_delivery_date"))
    # order 0 is hot (a third of all items); orders 1..n-1 have ~2 items each,
    # except every 10th order, which has none
    cold = (spark.range(2 * hot_items)
            .select((F.col("id") % (n_orders - 1) + 1).alias("order_id"), F.col("id").alias("k"))
            .where(F.col("order_id") % 10 != 0))
    hot = spark.range(hot_items).select(F.lit(0).cast("long").alias("order_id"), F.col("id").alias("k"))
    items = cold.unionByName(hot).select(
        "order_id", (F.col("k") % 1000).cast("int").alias("order_item_id"),
        (F.col("k") % 97).alias("product_id"), F.lit(1).alias("seller_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
        F.lit(1.25).alias("price"), F.lit(0.5).alias("freight_value"))
    payments = items.select("order_id", F.col("order_item_id").alias("payment_sequential"),
                            F.lit("card").alias("payment_type"),
                            F.lit(1).alias("payment_installments"), F.col("price").alias("payment_value"))
    return orders, items, payments


def _largest_task(df, column="order_id", value=0):
    per_task = (df.where(F.col(column) == value).select(F.spark_partition_id().alias("p"))
                .groupBy("p").count().collect())
    return max(r["count"] for r in per_task)


def test_hot_order_is_split_and_result_is_whole(spark, skew_conf):
    orders, items, payments = _inputs(spark)
    out = convert_orders(orders, items, payments)
    rows = out.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"),
                                        F.max("payment_value").alias("pv")).collect()
    by_id = {r.order_id: r for r in rows}
    expected = {r.order_id: r["count"] for r in items.groupBy("order_id").count().collect()}
    assert by_id[0].n == expected[0] == 6000
    assert by_id[0].pv == pytest.approx(6000 * 1.25)
    itemless = [o for o in range(600) if o not in expected]
    assert itemless and all(by_id[o].n == 1 for o in itemless)
    assert all(by_id[o].n == c for o, c in expected.items())
    assert sum(r.n for r in rows) == items.count() + len(itemless)


def test_hot_rows_never_reach_one_task(spark, skew_conf, tmp_path):
    """The written result shows the split: the hot order's rows are in several files."""
    out = convert_orders(*_inputs(spark))
    path = str(tmp_path / "orders")
    out.write.parquet(path)
    per_file = (spark.read.parquet(path).where("order_id = 0")
                .groupBy(F.col("_metadata.file_path")).count().collect())
    assert sum(r["count"] for r in per_file) == 6000
    assert max(r["count"] for r in per_file) < 6000


def test_plain_left_join_puts_hot_key_in_one_task(spark, skew_conf, tmp_path):
    orders, items, _ = _inputs(spark)
    path = str(tmp_path / "plain")
    orders.join(items, "order_id", "left").write.parquet(path)
    per_file = (spark.read.parquet(path).where("order_id = 0")
                .groupBy(F.col("_metadata.file_path")).count().collect())
    assert max(r["count"] for r in per_file) == 6000


def test_hot_and_null_lookups_stay_whole(spark, skew_conf):
    """A hot ZIP prefix, a hot category, and many rows without one."""
    customers = spark.range(4000).select(
        F.col("id").alias("customer_id"), F.col("id").cast("string").alias("customer_unique_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).cast("int")
        .alias("customer_zip_code_prefix"),
        F.lit("c").alias("customer_city"), F.lit("s").alias("customer_state"))
    geo = spark.range(3000).select(
        F.col("id").cast("int").alias("geolocation_zip_code_prefix"), F.lit(1.5).alias("geolocation_lat"),
        F.when(F.col("id") == 9, float("nan")).otherwise(2.5).alias("geolocation_lng"))
    out = convert_customers(customers, geo)
    assert out.count() == 4000
    assert out.where("customer_zip_code_prefix = '7' AND geolocation_lat = 1.5").count() == 1335
    assert out.where("customer_zip_code_prefix IS NULL AND geolocation_lat IS NULL").count() == 1333
    assert out.where("isnan(geolocation_lng)").count() == 0
    doubles = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
               "product_name_lenght", "product_description_lenght", "product_photos_qty"]
    products = spark.range(3000).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "hot").otherwise("cold")).alias("product_category_name"),
        *[F.lit(1.0).alias(c) for c in doubles])
    names = spark.createDataFrame([("hot", "HOT"), ("cold", "COLD")],
                                  "product_category_name string, product_category_name_english string")
    got = {r.e: r.n for r in convert_products(products, names).groupBy(F.col("category.english").alias("e"))
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"HOT": 1000, "COLD": 1000, None: 1000}


def test_conversion_reads_each_input_once(spark, skew_conf, tmp_path):
    """Scans per raw input over all jobs of the conversion: one, and one of the items' keys."""
    orders, items, payments = _inputs(spark)
    paths = {}
    for name, df in (("orders", orders), ("items", items), ("payments", payments)):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    frames = {n: spark.read.parquet(p) for n, p in paths.items()}
    # Spark shortens long paths in plan texts: enough room for any temp folder
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        out = convert_orders(frames["orders"], frames["items"], frames["payments"])
        plan = out._jdf.queryExecution().sparkPlan().toString()
        raw = frames["orders"]._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert raw.count(f"{paths['orders']}]") == 1  # a scan shows its path in this form
    # orders and payments went into the written heads, which are read for the join and the anti join
    assert plan.count(f"{paths['orders']}]") == 0 and plan.count(f"{paths['payments']}]") == 0
    scans = [line for line in plan.splitlines() if paths["items"] in line]
    assert len(scans) == 2
    assert any("ReadSchema: struct<order_id:bigint>" in line for line in scans)
    assert sum("order-heads" in line for line in plan.splitlines()) == 2
