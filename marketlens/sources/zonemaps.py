"""Zone maps: the least and greatest value per file, used to list the files a filter can touch.

Partition folders serve filters on their columns; Parquet's own statistics skip row
groups, but each file is still opened. A zone map is a small table (file, rows, least
and greatest value, nulls) that answers which files need opening at all. It pays
for columns that the files are laid out by (``write_clustered``).

Scale: the map is one scan of the mapped columns with one row per file; the filter on the
map is distributed, and only the names of files that can match go to the driver, which
hands them to the reader. Files added later are not in the map: build it again after a load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import materialize


def write_clustered(df: DataFrame, path: str, cols: list[str], codec: str = "snappy") -> str:
    """Parquet files that hold ranges of ``cols`` (sampled bounds), sorted inside."""
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.option("compression", codec).parquet(path)
    return path


def zone_map(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """(file, row_count, <name>_min, <name>_max, <name>_nulls) for each ``name: expression`` of ``cols``
    over a file-backed ``df``, written to the shared folder."""
    found = df.select(F.col("_metadata.file_path").alias("file"), *[F.expr(e).alias(n) for n, e in cols.items()])
    facts = [f(n) for n in cols for f in (
        lambda n: F.min(n).alias(f"{n}_min"), lambda n: F.max(n).alias(f"{n}_max"),
        lambda n: F.count_if(F.col(n).isNull()).alias(f"{n}_nulls"))]
    return materialize(found.groupBy("file").agg(F.count(F.lit(1)).alias("row_count"), *facts), "zones")


def touched_files(zones: DataFrame, name: str, low=None, high=None) -> list[str]:
    """Files that can hold a row with ``low <= name < high`` (an open end is None)."""
    can = F.col(f"{name}_min").isNotNull()
    if low is not None:
        can &= F.col(f"{name}_max") >= F.lit(low)
    if high is not None:
        can &= F.col(f"{name}_min") < F.lit(high)
    # the metadata column holds the path encoded as a URI
    path = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    return sorted(r.path for r in zones.where(can).select(path.alias("path")).collect())


def read_between(spark: SparkSession, df: DataFrame, base: str, zones: DataFrame, name: str, expr: str,
                 low=None, high=None) -> DataFrame:
    """Rows of the dataset at ``base`` (of which ``df`` has the schema) with ``low <= expr < high``,
    opening only the files that the zone map names. Rows without a value do not match."""
    files = touched_files(zones, name, low, high)
    rows = spark.read.schema(df.schema).option("basePath", base).parquet(*files) if files else df.limit(0)
    if low is not None:
        rows = rows.where(F.expr(expr) >= F.lit(low))
    if high is not None:
        rows = rows.where(F.expr(expr) < F.lit(high))
    return rows.where(F.expr(expr).isNotNull())
