"""Catalog tables over the converted datasets.

* ``create_namespace``     — ``CREATE DATABASE IF NOT EXISTS … LOCATION``.
* ``register_external``    — ``CREATE TABLE … USING parquet LOCATION`` per
                             dataset, then ``MSCK REPAIR TABLE`` so the
                             partitions found on disk are registered (before
                             the repair a partitioned table reads 0 rows).
* ``save_managed``         — managed table load: overwrite, partitioned,
                             partition columns last.
* ``save_bucketed``        — managed table bucketed and sorted by join keys.
* ``insert_idempotent``    — insert into an existing partitioned table with
                             dynamic partition overwrite: running the same
                             load twice leaves one copy of each row; the load
                             must hold whole partitions.
* ``merge_by_key``         — upsert: the rows of the load replace all rows of
                             their keys; other rows of the partitions stay.
* ``list_tables`` / ``schema_catalogue`` — what exists, and its columns.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.functions.expr import nan_free
from marketlens.schemas import LAYOUT
from marketlens.session import materialize, scratch_path




def new_namespace(spark: SparkSession, prefix: str = "marketlens") -> str:
    """A fresh database under the shared folder (unique name per call)."""
    name = f"{prefix}_{uuid.uuid4().hex[:10]}"
    create_namespace(spark, name, scratch_path(spark, "catalog", name))
    return name


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def _plain_path(location: str) -> str:
    """A location without the local scheme and trailing slashes, for comparison."""
    return re.sub(r"^file:/+", "/", location).rstrip("/")


def register_external(spark: SparkSession, db: str, table: str, path: str,
                      partition_by: list[str] | tuple = ()) -> str:
    """External table over an existing Parquet dataset, partitions recovered."""
    fq = f"{db}.{table}"
    if spark.catalog.tableExists(fq):
        # an external table of another folder is replaced: dropping it leaves the files
        known = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {fq}").collect()}
        if known.get("Type") != "EXTERNAL":
            raise ValueError(f"{fq} exists and is no external table")
        if _plain_path(known.get("Location", "")) != _plain_path(path):
            spark.sql(f"DROP TABLE {fq}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {fq} USING parquet LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {fq} SYNC PARTITIONS")
    return fq


def register_warehouse(spark: SparkSession, db: str, root: str) -> dict[str, str]:
    """External tables for all five datasets of a converted folder."""
    return {t: register_external(spark, db, t, f"{root.rstrip('/')}/{t}", lay["partition_by"])
            for t, lay in LAYOUT.items()}


def save_managed(df: DataFrame, fq_table: str, partition_by: list[str] | tuple = (),
                 codec: str = "snappy") -> str:
    """Drop-and-create load of a managed table (partition columns last, NaN as NULL)."""
    parts = list(partition_by)
    cols = [c for c in df.columns if c not in parts] + parts
    w = (nan_free(df).select(*cols).hint("rebalance", *parts).write.mode("overwrite")
         .option("compression", codec))
    if parts:
        w = w.partitionBy(*parts)
    w.saveAsTable(fq_table)
    return fq_table


def save_bucketed(df: DataFrame, fq_table: str, keys: list[str], buckets: int,
                  codec: str = "snappy") -> str:
    """Managed table dealt into ``buckets`` by the hash of ``keys`` and sorted by them.

    Tables with the same keys and bucket count join on these keys without moving rows:
    bucket i of one meets bucket i of the other. The rows are dealt by the same hash
    before the write, so there is one file a bucket. A bucket is a task of the join: size
    ``buckets`` for the table (256 MB each, say), and prefer a plain table for keys of which
    one holds a great share of all rows, because a bucket is never split.
    """
    (nan_free(df).repartition(buckets, *keys).write.mode("overwrite").option("compression", codec)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(fq_table))
    return fq_table


def insert_idempotent(spark: SparkSession, df: DataFrame, fq_table: str) -> None:
    """Insert with dynamic partition overwrite: re-running replaces, never doubles.

    Only the partitions present in ``df`` are rewritten; the column order of
    the target table is used (``insertInto`` is positional).
    """
    # insertInto ignores a per-write partitionOverwriteMode option (the session
    # decides), so the staged rows are written through a session of their own
    # with the same catalog; other writers of this session are not touched.
    path = scratch_path(spark, "load")
    _stage(df.select(*spark.table(fq_table).columns), path)
    _insert_staged(spark, path, fq_table)


# Rows of a staged file at most, and rows that a file of a table should have where its partition has enough.
STAGED_ROWS = 1_000_000
FILE_ROWS = 500_000


def _stage(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").option("maxRecordsPerFile", STAGED_ROWS).parquet(path)


def _insert_staged(spark: SparkSession, path: str, fq_table: str) -> None:
    """Replace the partitions that the staged rows belong to. Rows that lie by partition are not moved again."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    staged = own.read.schema(spark.table(fq_table).schema).parquet(path)
    parts = [c.name for c in spark.catalog.listColumns(fq_table) if c.isPartition]
    _shaped(staged, fq_table, rebalance=not lies_by_partition(staged, parts)).write.insertInto(fq_table, overwrite=True)


def lies_by_partition(staged: DataFrame, parts: list[str]) -> bool:
    """True if the files of ``staged`` hold few partitions each: written as they lie, a partition gets four files
    on average, or files of ``FILE_ROWS`` rows."""
    pieces = staged.groupBy(*parts, F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    n = pieces.agg(F.count(F.lit(1)).alias("pieces"), F.sum("_n").alias("rows")).first()
    partitions = pieces.select(*parts).distinct().count()
    return n["pieces"] <= 4 * partitions + (n["rows"] or 0) // FILE_ROWS


def _same(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    """Equal values or both null in all of ``cols``."""
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in cols])


def merge_by_key(spark: SparkSession, df: DataFrame, fq_table: str, keys: list[str]) -> None:
    """Upsert ``df`` into a partitioned table: all rows whose key is in ``df`` are replaced.

    Only touched partitions are rewritten: those that ``df`` has rows for, and those
    that hold a row with one of its keys (a row may move to another partition). Their new
    content is (old rows without these keys) and the rows of ``df``, staged in the shared
    folder first. Running the same load again changes nothing.

    Null keys are a key like others; columns of ``df`` beyond the table's are ignored; an
    empty load changes nothing; a partition that loses its last row is dropped. The keys are
    looked up with the key and partition columns only; the rows to be replaced go to all tasks as
    one bit for each row of the touched files (an eighth of a MB for a million rows). Two merges into one table must not
    run at once; readers may see some partitions new and others old.
    """
    target = spark.table(fq_table)
    parts = [c.name for c in spark.catalog.listColumns(fq_table) if c.isPartition]
    if not parts:
        raise ValueError(f"{fq_table} has no partitions")
    new = materialize(df.select(*target.columns), "merge_load")
    new_keys = materialize(new.select(*keys).distinct(), "merge_keys")
    file, at = F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.row_index") + 1).alias("_at")
    held = target.select(*dict.fromkeys([*keys, *parts]), file, at)
    # the replaced rows as a bitmap for each file: the other rows are read where they lie, not joined by key
    gone = materialize(held.join(new_keys, _same(held, new_keys, keys), "left_semi").groupBy(
        *parts, "_file", F.bitmap_bucket_number("_at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")), "merge_gone")
    touched = materialize(gone.select(*parts).union(new.select(*parts)).distinct(), "merge_partitions")
    # the partitions are joined by plain equality, which lets Spark prune them; null ones by a filter
    placed = target.select(*target.columns, file, at)
    old = placed.join(touched, parts, "left_semi").select(*placed.columns)
    without_value = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in parts])
    if touched.where(without_value).limit(1).count():
        hidden = placed.where(without_value)
        old = old.unionByName(hidden.join(touched, _same(hidden, touched, parts), "left_semi"))
    marked = old.withColumn("_bucket", F.bitmap_bucket_number("_at")).join(
        F.broadcast(gone.select("_file", "_bucket", "_bits")), ["_file", "_bucket"], "left")
    byte = "CAST(conv(hex(substring(_bits, CAST(bitmap_bit_position(_at) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    kept = marked.where(f"_bits IS NULL OR getbit({byte}, CAST(bitmap_bit_position(_at) % 8 AS INT)) = 0")
    path = scratch_path(spark, "merge_rows")
    _stage(kept.select(*target.columns).unionByName(new), path)
    staged = spark.read.schema(target.schema).parquet(path)
    _insert_staged(spark, path, fq_table)
    emptied = touched.join(staged.select(*parts).distinct(), parts, "left_anti").where(~without_value).collect()
    for row in emptied:  # partitions that lost their last row
        spec = ", ".join(f"{c} = '{row[c]}'" for c in parts)
        spark.sql(f"ALTER TABLE {fq_table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(fq_table)


def _shaped(df: DataFrame, fq_table: str, rebalance: bool = True) -> DataFrame:
    """Columns of the target, rebalanced by its partitions (few files each) where they do not lie so already."""
    columns = df.sparkSession.catalog.listColumns(fq_table)
    parts = [c.name for c in columns if c.isPartition]
    shaped = nan_free(df).select(*[c.name for c in columns])
    return shaped.hint("rebalance", *parts) if rebalance else shaped


def insert_append(df: DataFrame, fq_table: str) -> None:
    """Plain append (``INSERT INTO``): a second run doubles the rows."""
    _shaped(df, fq_table).write.insertInto(fq_table, overwrite=False)


def list_tables(spark: SparkSession, db: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(db))


def _flatten(schema: StructType, prefix: str = ""):
    for f in schema.fields:
        name = prefix + f.name
        yield name, f.dataType.simpleString()
        if isinstance(f.dataType, StructType):
            yield from _flatten(f.dataType, name + ".")


def schema_catalogue(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, column, struct sub-field): type and partition flag.

    Built from the table schemas (metadata only), e.g. to give a SQL author
    or a tool the list of queryable columns.
    """
    rows = []
    for t, df in tables.items():
        parts = set(LAYOUT.get(t, {}).get("partition_by", []))
        for col, typ in _flatten(df.schema):
            rows.append((t, col, typ, col in parts, "." in col))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, "
              "is_partition boolean, is_subfield boolean").orderBy("table_name", "column_name")

