"""Format and catalog round trips over the converted tables.

Each function writes a converted table in some form (CSV, JSON lines, a
catalog table) to a fresh folder under the shared scratch location, reads it
back the way a user would, and returns the DataFrame read back. The result
must equal the source table — that is what the registered checks compare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.schemas import LAYOUT, TABLES
from marketlens.operators.distinct import keep_bitmaps
from marketlens.session import scratch_path
from marketlens.sinks.parquet import CSV_NULL, write_csv, write_json
from marketlens.sinks.snapshots import read_current, refresh
from marketlens.sources import catalog as C
from marketlens.sources.files import read_csv, read_csv_checked, read_csv_in_splits, read_json
from marketlens.sources.warehouse import Tables, TablesOnDemand
from marketlens.sources.zonemaps import read_between, write_clustered, zone_map


def csv_roundtrip(spark: SparkSession, df: DataFrame, multi_line: bool = False) -> DataFrame:
    """Write CSV (header, quoted newlines / quotes, compressed) and read it back typed."""
    path = scratch_path(spark, "csv")
    write_csv(df, path, null_value=CSV_NULL, codec="gzip")
    return read_csv(spark, path, df.schema, null_value=CSV_NULL, multi_line=multi_line)


def csv_split_roundtrip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The same with quoted line breaks put together from split files."""
    path = scratch_path(spark, "csv")
    write_csv(df, path, null_value=CSV_NULL)
    return read_csv_in_splits(spark, path, df.schema, null_value=CSV_NULL)


def csv_good_and_bad(spark: SparkSession, payments: DataFrame, every: int) -> DataFrame:
    """Payments written as text with the instalments of every ``every``-th order spoilt, read with
    bad rows kept apart: rows and sum of order ids of either kind."""
    path = scratch_path(spark, "csv-spoilt")
    spoilt = F.when(F.col("order_id") % every == 0, F.lit("x1")).otherwise(F.col("payment_installments").cast("string"))
    write_csv(payments.withColumn("payment_installments", spoilt), path, null_value=CSV_NULL)
    good, bad = read_csv_checked(spark, path, payments.schema, null_value=CSV_NULL)
    bad_ids = bad.select(F.substring_index(F.col(bad.columns[0]), ",", 1).cast("long").alias("order_id"))
    totals = [F.count(F.lit(1)).alias("row_count"), F.sum("order_id").alias("id_sum")]
    return (good.agg(*totals).select(F.lit("good").alias("kind"), "*")
            .unionByName(bad_ids.agg(*totals).select(F.lit("bad").alias("kind"), "*")))


def json_roundtrip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write JSON lines, compressed, and read them back with the same schema."""
    path = scratch_path(spark, "json")
    write_json(df, path, codec="gzip")
    return read_json(spark, path, df.schema)


def csv_projected(spark: SparkSession, df: DataFrame, cols=("order_id", "order_status")) -> DataFrame:
    """Column subset of a CSV copy (the parser only materialises these columns)."""
    return csv_roundtrip(spark, df).select(*cols)


def csv_prefix_filter(spark: SparkSession, df: DataFrame, ts_col: str, prefix: str) -> DataFrame:
    """Rows of a CSV copy whose timestamp text starts with ``prefix`` (e.g. '2017-10')."""
    return csv_roundtrip(spark, df).where(F.col(ts_col).cast("string").startswith(prefix))


def parquet_partition_filter(t: Tables, year: int, month: int) -> DataFrame:
    """Orders of one month: reads only the ``year=…/month=…`` directory."""
    return t.orders.where((F.col("year") == year) & (F.col("month") == month))


def parquet_projected(t: Tables, cols=("order_id", "order_status")) -> DataFrame:
    """Two columns of orders: the scan's ReadSchema holds only these."""
    return t.orders.select(*cols)


def external_tables(spark: SparkSession, t: Tables) -> dict[str, str]:
    """Register the converted datasets as external tables in a new database."""
    db = C.new_namespace(spark)
    return C.register_warehouse(spark, db, t.root)


def managed_load(spark: SparkSession, t: Tables, name: str) -> DataFrame:
    """Typed load of one converted dataset into a managed table (NaN as NULL)."""
    return managed_table(spark, getattr(t, name), name)


def plain_append(spark: SparkSession, t: Tables, runs: int = 2) -> DataFrame:
    """``runs`` plain appends of the sellers: every row that many times."""
    db = C.new_namespace(spark)
    fq = C.save_managed(t.sellers.limit(0), f"{db}.sellers", [], LAYOUT["sellers"]["codec"])
    for _ in range(runs):
        C.insert_append(t.sellers, fq)
    return spark.table(fq)


def managed_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Load ``df`` into a managed table with its layout; return the table."""
    db = C.new_namespace(spark)
    fq = C.save_managed(df, f"{db}.{name}", LAYOUT[name]["partition_by"], LAYOUT[name]["codec"])
    return spark.table(fq)


def idempotent_reload(spark: SparkSession, t: Tables, runs: int = 2) -> DataFrame:
    """Initial load of the first half-year partitions of orders, then ``runs``
    full loads with dynamic partition overwrite: loaded partitions are
    replaced, new ones added, and the table ends with one copy of every row."""
    db = C.new_namespace(spark)
    fq = C.save_managed(t.orders.where(F.col("month") <= 6), f"{db}.orders",
                        LAYOUT["orders"]["partition_by"])
    for _ in range(runs):
        C.insert_idempotent(spark, t.orders, fq)
    return spark.table(fq)


def merged_reload(spark: SparkSession, t: Tables, runs: int = 2) -> DataFrame:
    """Orders loaded with every second order wrong (other status, other month), then the right rows of
    these orders merged ``runs`` times: the other half of each month stays, the table is whole."""
    wrong = F.col("order_id") % 2 == 0
    first = (t.orders.withColumn("order_status", F.when(wrong, "stale").otherwise(F.col("order_status")))
             .withColumn("month", F.when(wrong, 13 - F.col("month")).otherwise(F.col("month"))))
    fq = C.save_managed(first, f"{C.new_namespace(spark)}.orders", LAYOUT["orders"]["partition_by"])
    for _ in range(runs):
        C.merge_by_key(spark, t.orders.where(wrong), fq, ["order_id"])
    return spark.table(fq)


def refreshed(spark: SparkSession, t: Tables) -> DataFrame:
    """Orders refreshed twice in one place: first without order states and with a year of their own for
    some, then right. The second version has no partition of the first one left."""
    root = scratch_path(spark, "refreshed")
    refresh(spark, {"orders": t.orders.withColumn("year", F.col("year") + 100), "sellers": t.sellers.limit(0)}, root)
    refresh(spark, {"orders": t.orders, "sellers": t.sellers}, root)
    return read_current(spark, root, "orders")


# Rows of the orders that one bucket is planned for, so that its task sorts them in memory; least count of buckets.
BUCKET_ROWS = 2_000_000
LEAST_BUCKETS = 16


def bucketed_tables(spark: SparkSession, t: Tables, key: str, buckets: int | None = None) -> Tables:
    """The tables with ``key`` bucketed by it, so that joins on it move no rows; others as they are.

    A table is bucketed when it is first asked for. All have the same count of buckets: by
    the rows of the orders, the largest table, where none is given."""
    db = C.new_namespace(spark)
    buckets = buckets or max(LEAST_BUCKETS, -(-t.orders.count() // BUCKET_ROWS))

    def make(name: str) -> DataFrame:
        df = getattr(t, name)
        if key not in df.columns:
            return df
        return spark.table(C.save_bucketed(df, f"{db}.{name}", [key], buckets, LAYOUT[name]["codec"]))

    return TablesOnDemand({n: lambda n=n: make(n) for n in TABLES}, lambda: t.root)


def zone_pruned_orders(spark: SparkSession, t: Tables, low: str, high: str) -> DataFrame:
    """Orders bought in a span of days, from files laid out by time: only files whose zone meets
    the span are opened."""
    path = write_clustered(t.orders, scratch_path(spark, "clustered"), ["order_purchase_timestamp", "order_id"])
    df = spark.read.schema(t.orders.schema).parquet(path)
    zones = zone_map(df, {"bought": "order_purchase_timestamp"})
    span = [F.lit(d).cast("timestamp_ntz") for d in (low, high)]
    return read_between(spark, df, path, zones, "bought", "order_purchase_timestamp", *span)


def zone_pruned_products(spark: SparkSession, t: Tables, max_weight: float) -> DataFrame:
    """Flat products under a weight, from files laid out by the nested weight."""
    from marketlens.operators.etl import products_flat

    path = write_clustered(t.products, scratch_path(spark, "clustered"), ["dimensions.weight_g", "product_id"])
    df = spark.read.schema(t.products.schema).parquet(path)
    zones = zone_map(df, {"weight": "dimensions.weight_g"})
    return products_flat(read_between(spark, df, path, zones, "weight", "dimensions.weight_g", None, max_weight))


def order_bitmaps(t: Tables, key: str) -> DataFrame:
    """Distinct values of an order column as bitmaps per month and customer state."""
    c = t.customers.select("customer_id", "customer_state")
    return keep_bitmaps(t.orders.join(c, "customer_id"), key, ["year", "month", "customer_state"])


def event_spans(events: DataFrame) -> DataFrame:
    """Per user: first and last event, whole days between them both ways."""
    from marketlens.functions.expr import days_between

    per_user = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return per_user.select("user_id", "first_ts", "last_ts",
                           days_between("first_ts", "last_ts").alias("span_days"),
                           days_between("last_ts", "first_ts").alias("span_days_reversed"))
