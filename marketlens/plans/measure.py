"""Measurement and data-quality jobs.

* ``storage_footprint`` — files and bytes per dataset / format, listed by the
  ``binaryFile`` source with only the ``length`` column read (file contents
  are never loaded).
* ``pruning_evidence``   — which partitions, files and bytes a filtered scan
  touches, from the scan's own ``_metadata`` columns, against all files.
* ``format_read_times``  — the same table as CSV, JSON lines and Parquet:
  full, projected and filtered reads, timed (mean of n runs) through the
  ``noop`` sink so that only the read is measured.
* ``timed``              — wall time and row count of one action.
* ``dataset_checks``     — the output checks of the conversion: partition
  directories, row minimums, required columns, structs, codecs.
* ``plan_text``          — the formatted physical plan (for plan assertions).

Times and sizes have no oracle; they are reported, not compared.
"""

from __future__ import annotations

import contextlib
import io
import statistics
import time

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.schemas import LAYOUT
from marketlens.session import scratch_path
from marketlens.sinks.parquet import CSV_NULL, write_csv, write_json, write_table
from marketlens.sources.testdata import RawInputs
from marketlens.sources.files import read_csv, read_json, read_parquet
from marketlens.sources.warehouse import Tables


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of every file below ``path`` matching ``glob``."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .load(path)
            .select("path", "length"))


def storage_footprint(spark: SparkSession, datasets: dict[tuple[str, str], tuple[str, str]]) -> DataFrame:
    """Files and bytes per (format, table).

    ``datasets`` maps ``(format, table)`` to ``(path, file glob)``.
    """
    parts = [list_files(spark, path, glob).select(F.lit(fmt).alias("format"),
                                                   F.lit(table).alias("table_name"), "length")
             for (fmt, table), (path, glob) in datasets.items()]
    files = parts[0]
    for p in parts[1:]:
        files = files.unionByName(p)
    return (files.groupBy("format", "table_name")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").cast("long").alias("bytes"))
            .withColumn("mb", F.round(F.col("bytes") / (1024 * 1024), 3))
            .orderBy("format", "table_name"))


def storage_summary(footprint: DataFrame, baseline: str = "csv") -> DataFrame:
    """Total bytes per format and the reduction against ``baseline`` (in %)."""
    per_format = footprint.groupBy("format").agg(F.sum("bytes").cast("long").alias("bytes"))
    base = per_format.where(F.col("format") == baseline).agg(F.sum("bytes")).scalar()
    return (per_format
            .select("format", "bytes", F.round(F.col("bytes") / (1024 * 1024), 3).alias("mb"),
                    F.round((F.lit(1.0) - F.col("bytes") / base) * 100, 1)
                    .alias("pct_smaller_than_" + baseline))
            .orderBy("format"))


def pruning_evidence(filtered_scan: DataFrame, all_files: DataFrame,
                     partition_cols: list[str]) -> DataFrame:
    """Partitions / files / bytes a filtered scan reads, against the whole table.

    ``filtered_scan`` must be a (filtered) file scan; ``all_files`` the
    ``list_files`` listing of its dataset. Exact for partition filters; a file
    that is opened but yields no row is not seen.
    """
    touched = (filtered_scan.select(*partition_cols, F.col("_metadata.file_path").alias("path"),
                                    F.col("_metadata.file_size").alias("length"))
               .distinct())
    # One file belongs to one partition, so (partition, path, length) rows
    # are distinct per file; every figure is one aggregate, totals are a
    # scalar subquery over the listing.
    total = all_files.agg(F.struct(F.count(F.lit(1)).alias("files"),
                                   F.sum("length").cast("long").alias("bytes"))).scalar()
    read = touched.agg(
        F.countDistinct(*partition_cols).alias("partitions_read"),
        F.count(F.lit(1)).alias("files_read"),
        F.sum("length").cast("long").alias("bytes_read"))
    return (read.select("*", total.alias("_t"))
            .select("partitions_read", "files_read", F.col("_t.files").alias("files_total"),
                    "bytes_read", F.col("_t.bytes").alias("bytes_total"),
                    F.round(F.col("bytes_read") / F.col("_t.bytes") * 100, 2).alias("pct_bytes_read")))


def pruned_rows(table: DataFrame, filtered: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Partitions and rows that a filter leaves, against the whole table (one row)."""
    count = lambda df: df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n")).agg(
        F.struct(F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows")).alias("c"))
    return count(filtered).select("c", count(table).scalar().alias("t")).select(
        F.col("c.partitions").alias("partitions_read"), F.col("t.partitions").alias("partitions_total"),
        F.col("c.rows").alias("rows_read"), F.col("t.rows").alias("rows_total"))


def timed(df: DataFrame) -> tuple[float, int]:
    """Seconds to run ``df`` to completion (noop sink) and its row count.

    The count comes from an observation on the same run, so it costs no
    second pass.
    """
    from pyspark.sql import Observation

    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    t0 = time.perf_counter()
    observed.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0, int(obs.get["n"])


def repeated(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times: a larger input for the read timings."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_copy")


def format_copies(spark: SparkSession, df: DataFrame, text_codec: str = "none", text_level: str | None = None,
                  stored: str | None = None) -> dict[str, str]:
    """Write ``df`` (orders) as CSV, JSON lines and partitioned Parquet, at once; return paths.

    Where ``df`` is just the dataset of folder ``stored``, its files hold a partition each and its
    rows are not moved for the Parquet copy."""
    paths = {f: scratch_path(spark, f"fmt-{f}") for f in ("csv", "json", "parquet")}
    lying = _small_splits(spark, df, stored)
    rows, moved = (df, True) if lying is None else (lying, False)
    writes = [lambda: write_csv(df, paths["csv"], null_value=CSV_NULL, codec=text_codec, level=text_level),
              lambda: write_json(df, paths["json"], codec=text_codec, level=text_level),
              lambda: write_table(rows, paths["parquet"], LAYOUT["orders"]["partition_by"], LAYOUT["orders"]["codec"],
                                  rebalance=moved)]
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for job in [pool.submit(w) for w in writes]:
            job.result()
    return paths


def _small_splits(spark: SparkSession, df: DataFrame, stored: str | None) -> DataFrame | None:
    """``df`` in tasks whose rows can be sorted by partition in memory, where it is the dataset of ``stored``."""
    if stored is None or not df.sameSemantics(read_parquet(spark, stored)):
        return None
    aside = spark.newSession()  # the session's own split size is left alone
    aside.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    return aside.read.schema(df.schema).option("basePath", stored).parquet(stored)


# The columns whose text is the same in every format and engine.
DIGEST_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
                  "order_item_id", "product_id", "seller_id", "CAST(price AS DECIMAL(28,8))", "payment_type",
                  "payment_installments", "CAST(payment_value AS DECIMAL(28,8))", "year", "month"]


HALF = 1 << 24


def rows_digest(df: DataFrame, cols: list[str]) -> DataFrame:
    """(row_count, digest): the sum of 48 bits of every row's MD5, whatever the order of rows.

    The bits are summed as longs in two halves of 24 bits, exact for 2^39 rows: a sum of
    decimals works out its argument, here the row's text and MD5, twice for every row."""
    text = F.concat_ws("|", *[F.coalesce(F.expr(f"CAST({c} AS STRING)"), F.lit("~")) for c in cols])
    bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    sums = df.select(bits.alias("bits")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.shiftright("bits", 24)).alias("high"),
        F.sum(F.col("bits").bitwiseAND(F.lit(HALF - 1))).alias("low"))
    whole = F.col("high").cast("decimal(20,0)") * F.lit(HALF) + F.col("low")
    return sums.select("row_count", F.coalesce(whole, F.lit(0)).cast("string").alias("digest"))


def _of_month(year: int, month: int):
    """The timestamp's text starts with the month. The bounds say nothing more, but a text reader
    takes them: it parses the other columns only for rows within them."""
    ts, first = F.col("order_purchase_timestamp"), f"TIMESTAMP_NTZ'{year:04d}-{month:02d}-01 00:00:00'"
    return ((ts >= F.expr(first)) & (ts < F.expr(f"{first} + INTERVAL '1' MONTH"))
            & ts.cast("string").startswith(f"{year}-{month:02d}"))


def format_equality(spark: SparkSession, t: Tables, year: int, month: int) -> DataFrame:
    """MSR3: the full, projected and filtered read of the orders as CSV, JSON lines and Parquet;
    equal digests show that the three formats hold the same rows. The text formats filter on the
    timestamp's text, Parquet on the partition. The text copies are compressed: plain ones take
    some thirty times the room of the Parquet copy (level 3: a third less work than the usual 6)."""
    paths = format_copies(spark, t.orders, text_codec="gzip", text_level="THREE", stored=t.path("orders"))
    schema = t.orders.schema
    reads = {"csv": read_csv(spark, paths["csv"], schema, null_value=CSV_NULL, own=True),
             "json": read_json(spark, paths["json"], schema, own=True), "parquet": read_parquet(spark, paths["parquet"])}
    out = None
    for name, df in reads.items():
        one_month = df.where((F.col("year") == year) & (F.col("month") == month) if name == "parquet"
                             else _of_month(year, month))
        for read, rows, cols in (("full", df, DIGEST_COLUMNS), ("projected", df, ["order_id", "order_status"]),
                                 ("filtered", one_month, DIGEST_COLUMNS)):
            got = rows_digest(rows, cols).select(F.lit(name).alias("format"), F.lit(read).alias("read"), "row_count", "digest")
            out = got if out is None else out.unionByName(got)
    return out


def format_read_times(spark: SparkSession, t: Tables, year: int, month: int,
                      iterations: int = 3, project=("order_id", "order_status"),
                      copies: dict[str, str] | None = None) -> DataFrame:
    """Full / projected / filtered reads of ``orders`` in three formats
    (``copies``: paths from ``format_copies``, written if absent). Each read is
    warmed once; the median of ``iterations`` runs counts."""
    orders = t.orders
    schema: StructType = orders.schema
    copies = copies or format_copies(spark, orders)
    readers = {
        "csv": lambda: read_csv(spark, copies["csv"], schema, null_value=CSV_NULL),
        "json": lambda: read_json(spark, copies["json"], schema),
        "parquet": lambda: read_parquet(spark, copies["parquet"]),
    }
    prefix = f"{year:04d}-{month:02d}"
    kinds = {
        "full": lambda fmt, d: d,
        "projected": lambda fmt, d: d.select(*project),
        "filtered": lambda fmt, d: (
            d.where((F.col("year") == year) & (F.col("month") == month)) if fmt == "parquet"
            else d.where(F.col("order_purchase_timestamp").cast("string").startswith(prefix))),
    }
    rows = []
    for kind, shape in kinds.items():
        for fmt, reader in readers.items():
            secs, n = [], 0
            timed(shape(fmt, reader()))  # warm: code generation and file listing
            for _ in range(iterations):
                s, n = timed(shape(fmt, reader()))
                secs.append(s)
            rows.append((kind, fmt, statistics.median(secs), n))
    out = spark.createDataFrame(rows, "read_kind string, format string, seconds double, rows long")
    base = (out.where(F.col("format") == "csv")
            .select("read_kind", F.col("seconds").alias("_csv")))
    return (out.join(base, "read_kind", "left")
            .select("read_kind", "format", F.round("seconds", 4).alias("seconds"), "rows",
                    F.round(F.col("_csv") / F.col("seconds"), 2).alias("speedup_vs_csv"))
            .orderBy("read_kind", "format"))


def dataset_checks(spark: SparkSession, t: Tables, min_rows: dict[str, int] | None = None,
                   review_partitions: int | None = None) -> DataFrame:
    """Checks of the converted datasets: (check, ok, detail), one row each."""
    min_rows = min_rows or {}
    counts = {r["table_name"]: r["row_count"] for r in _counts(t).collect()}
    years = t.orders.select("year").distinct().count()
    scores = t.reviews.select("review_score").distinct().count()
    rows = [
        ("orders partitioned by year", years >= 2, f"{years} year partitions"),
        ("reviews partitioned by score",
         scores == review_partitions if review_partitions else scores >= 1,
         f"{scores} review_score partitions"),
    ]
    for table, n in sorted(counts.items()):
        need = min_rows.get(table, 0)
        rows.append((f"{table} row count > {need}", n > need, f"{n} rows"))
    need_cols = {"order_id", "customer_id", "order_status", "price", "freight_value"}
    have = set(t.orders.columns)
    rows.append(("orders has required columns", need_cols <= have,
                 "missing: " + ", ".join(sorted(need_cols - have)) if need_cols - have else "all present"))
    ptypes = {f.name: f.dataType for f in t.products.schema.fields}
    for s in ("category", "dimensions"):
        rows.append((f"products.{s} is a struct", isinstance(ptypes.get(s), StructType),
                     ptypes[s].simpleString() if s in ptypes else "absent"))
    for table, lay in LAYOUT.items():
        codec = lay["codec"]
        files = list_files(spark, f"{t.root.rstrip('/')}/{table}", "*.parquet")
        stats = files.agg(F.count(F.lit(1)).alias("n"),
                          F.sum(F.col("path").endswith(f".{codec}.parquet").cast("int")).alias("m")).first()
        rows.append((f"{table} files use {codec}", stats["n"] > 0 and stats["n"] == stats["m"],
                     f"{stats['m']} of {stats['n']} files"))
    return spark.createDataFrame(rows, "check string, ok boolean, detail string")


# Columns that a dataset cannot be used without.
REQUIRED = {
    "orders": ["order_id", "customer_id", "order_status"],
    "products": ["product_id"],
    "customers": ["customer_id", "customer_state"],
    "reviews": ["review_id", "order_id", "review_score"],
    "sellers": ["seller_id"],
}


# The raw input that a dataset has at least as many rows as.
RAW_OF = {"orders": "items", "products": "products", "customers": "customers", "reviews": "reviews", "sellers": "sellers"}


def raw_minimums(raw: RawInputs) -> dict[str, int]:
    """Rows of each dataset's raw input (orders: of the items, an order without any adds a row)."""
    return {name: getattr(raw, source).count() for name, source in RAW_OF.items()}


def table_checks(t: Tables, min_rows: dict[str, int], min_partitions: dict[str, int]) -> DataFrame:
    """One row per dataset, computed in one aggregate each: rows, their minimum,
    rows that lack a required value, partitions, and whether all is well. An order row with an
    item must have its price and freight value."""
    out = None
    for name, df in t.as_dict().items():
        parts = LAYOUT[name]["partition_by"]
        lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED[name]])
        if name == "orders":
            lacking = lacking | F.expr("order_item_id IS NOT NULL AND (price IS NULL OR freight_value IS NULL)")
        key = F.struct(*parts) if parts else F.lit(0)
        one = df.agg(F.count(F.lit(1)).alias("row_count"),
                     F.coalesce(F.sum(lacking.cast("long")), F.lit(0).cast("long")).alias("incomplete"),
                     F.countDistinct(key).alias("partitions"))
        need = int(min_rows.get(name, 0))
        one = one.select(F.lit(name).alias("table_name"), "row_count", F.lit(need).cast("long").alias("min_rows"),
                         "incomplete", "partitions",
                         ((F.col("row_count") > 0) & (F.col("row_count") >= need) & (F.col("incomplete") == 0)
                          & (F.col("partitions") >= min_partitions.get(name, 1))).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def _counts(t: Tables) -> DataFrame:
    from marketlens.plans.reports import overview

    return overview(t).where(F.col("table_name") != "total")


def measure_storage(spark: SparkSession, t: Tables) -> DataFrame:
    """Footprint of the five datasets as Parquet and as CSV (structs flattened)."""
    datasets = {}
    for name, df in {**t.as_dict(), "products": t.products_flat}.items():
        path = scratch_path(spark, "size-csv", name)
        write_csv(df, path, null_value=CSV_NULL)
        datasets[("csv", name)] = (path, "*.csv")
        datasets[("parquet", name)] = (f"{t.root.rstrip('/')}/{name}", "*.parquet")
    return storage_footprint(spark, datasets)
