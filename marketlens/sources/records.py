"""CSV whose quoted fields hold line breaks, read by many tasks.

Spark reads a ``multiLine`` file with one task. ``read_quoted_csv`` reads the same file
as lines, split wherever Spark splits it, and puts the records together again with
built-in functions:

1. a line's place is (file, start of its split, order in the split);
2. a line begins inside a quoted field when an odd number of quotes stands before it
   in the file: a running sum inside each split, plus the sums of the file's earlier splits
   (one row for each split);
3. a line that begins outside a quoted field begins a record. Records of one line,
   nearly all, are complete. The lines of the others are grouped by the place where
   their record begins and joined with the line breaks they had;
4. ``from_csv`` parses the records.

Scale: the lines are shuffled once, by split, so that no task gets more than a split;
only the lines of records with breaks are shuffled a second time. One group is one record.

The file must be quoted as usual (RFC 4180: a quote inside a quoted field is doubled, no
quote in an unquoted field). Each file has a header record. ``\\r\\n`` ends a record like
``\\n`` and is kept inside fields. Empty records are skipped. An empty file gives no rows.
A quote that is never closed makes the rest of its file one record, as in Spark's reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUOTE = '"'


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line, record): every record of the CSV files at ``path`` but their headers;
    ``split`` and ``line`` are the place where it begins."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("line"), "value")
             .withColumn("quotes", (F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))).cast("long")))
    in_split = Window.partitionBy("file", "split").orderBy("line")
    before = F.coalesce(F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.select("*", before.alias("before"), F.row_number().over(in_split).alias("nth"))

    # what the earlier splits of the file leave: the parity of quotes, and the place of the last record begun
    splits = lines.groupBy("file", "split").agg(
        F.sum("quotes").alias("quotes"),
        F.max(F.when(F.col("before") % 2 == 0, F.col("line"))).alias("even"),
        F.max(F.when(F.col("before") % 2 == 1, F.col("line"))).alias("odd"))
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("carried", F.coalesce(F.sum("quotes").over(in_file), F.lit(0)) % 2)
    splits = splits.withColumn("begun", F.when(F.col("carried") == 0, F.col("even")).otherwise(F.col("odd")))
    splits = splits.select("file", "split", "carried", F.last(
        F.when(F.col("begun").isNotNull(), F.struct("split", F.col("begun").alias("line"))), True).over(in_file).alias("open"))

    # both sides are dealt by (file, split): the lines are not moved again
    placed = lines.join(splits, ["file", "split"]).withColumn("begins", (F.col("before") + F.col("carried")) % 2 == 0)
    here = F.when(F.col("begins"), F.struct("split", "line"))
    placed = placed.withColumn("of", F.coalesce(F.last(here, True).over(in_split), "open"))
    header = (F.col("split") == 0) & F.col("begins") & (F.col("nth") == 1)
    whole = F.col("begins") & (F.col("quotes") % 2 == 0)
    single = placed.where(whole & ~header).select("file", "split", "line", F.col("value").alias("record"))
    parts = placed.where(~whole).select("file", F.col("of.split").alias("of_split"), F.col("of.line").alias("of_line"),
                                        "split", "line", "value", header.alias("header"))
    joined = parts.groupBy("file", "of_split", "of_line").agg(
        F.expr(r"listagg(value, '\n') WITHIN GROUP (ORDER BY split, line)").alias("record"), F.max("header").alias("header"))
    broken = joined.where("NOT header").select("file", F.col("of_split").alias("split"), F.col("of_line").alias("line"),
                                               "record")
    records = single.unionByName(broken)
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType, options: dict[str, str]) -> DataFrame:
    """The records at ``path`` parsed by ``from_csv`` with the CSV reader's ``options``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col("record"), F.lit(ddl), {**options, "multiLine": "true"})
    return csv_records(spark, path).select(parsed.alias("r")).select("r.*")
