"""Writers: partitioned / plain Parquet with a codec, JSON lines, CSV.

File sizing. A partitioned write is preceded by a ``REBALANCE`` hint on the
partition columns: adaptive execution then merges small shuffle partitions
and *splits* skewed ones into advisory-sized pieces
(``spark.sql.adaptive.advisoryPartitionSizeInBytes``). One hot month — or a
third of all rows in one partition value — becomes many files of bounded size
instead of one huge file, and a day of small partitions does not become
thousands of tiny files. Full refreshes overwrite statically (stale
partitions vanish); incremental loads use dynamic partition overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: list[str] | tuple = (),
                codec: str = "snappy", mode: str = "overwrite",
                overwrite: str = "static", rebalance: bool = True) -> str:
    """Write ``df`` as a Parquet dataset at ``path``.

    ``overwrite='static'`` is a full refresh (the whole target is replaced);
    ``'dynamic'`` replaces only the partitions present in ``df``.
    ``rebalance=False`` is for rows that lie in files of one partition each: they are not moved.
    """
    parts = list(partition_by)
    shaped = (df.hint("rebalance", *parts) if parts else df.hint("rebalance")) if rebalance else df
    w = (shaped.write.mode(mode)
         .option("compression", codec)
         .option("partitionOverwriteMode", overwrite))
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
    return path


# Rows of one compressed text file: such a file is read by one task.
TEXT_ROWS = 500_000


def write_json(df: DataFrame, path: str, mode: str = "overwrite", codec: str = "none",
               level: str | None = None) -> str:
    """JSON-lines files (one object per row); compressed ones hold ``TEXT_ROWS`` rows at most.
    ``level`` is a gzip level of Hadoop (``THREE``, ``BEST_SPEED``, ...)."""
    (_text_writer(df, mode, codec, level)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path))
    return path


def _text_writer(df: DataFrame, mode: str, codec: str, level: str | None):
    w = df.write.mode(mode).option("compression", codec)
    if level:
        w = w.option("zlib.compress.level", level)
    return w if codec == "none" else w.option("maxRecordsPerFile", TEXT_ROWS)


# NULL marker of the CSV files we write ourselves: an empty string is written
# as "" and NULL as \N, so the two stay distinct after a round trip.
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = CSV_NULL,
              codec: str = "none", level: str | None = None) -> str:
    """CSV with a header row; quotes and embedded newlines are escaped,
    surrounding whitespace is kept. Compressed files hold ``TEXT_ROWS`` rows at most
    (``level`` as in ``write_json``)."""
    (_text_writer(df, mode, codec, level).option("header", True).option("escape", '"')
     .option("nullValue", null_value).option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))
    return path
