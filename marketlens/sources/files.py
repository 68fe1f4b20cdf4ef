"""File readers: raw CSV inputs, CSV / JSON / Parquet datasets.

CSV is always read with an explicit schema: inference costs a full extra pass
at scale and guesses types differently per file. ``multiLine`` + ``escape='"'``
parse quoted newlines and doubled quotes correctly, but such a file is read by one
task; files whose texts may hold line breaks (reviews) are read in splits by
``records.read_quoted_csv``. All other files are split by Spark itself.

``read_csv_checked`` keeps bad rows apart: good rows typed, bad rows as their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlens.schemas import RAW_FILES, RAW_SCHEMAS
from marketlens.session import materialize
from marketlens.sources.records import read_quoted_csv
from marketlens.sources.testdata import RawInputs

NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


# Fixed value: the raw input whose quoted texts may hold line breaks.
MULTI_LINE = {"reviews"}


def _options(mode: str, null_value: str) -> dict[str, str]:
    return {"nullValue": null_value, "emptyValue": "", "escape": '"', "mode": mode, "timestampNTZFormat": NTZ_FORMAT,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: StructType, mode: str = "FAILFAST",
             null_value: str = "", multi_line: bool = False, own: bool = False) -> DataFrame:
    """CSV with a header row and explicit schema.

    ``mode='FAILFAST'`` raises on a malformed value (e.g. an unparsable
    timestamp) instead of silently turning it into NULL. Raw inputs mark a
    missing value with an empty field (``null_value=''``); files written by
    ``sinks.write_csv`` use ``\\N`` so that ``''`` survives. ``multi_line`` lets a
    quoted field hold line breaks, at the price of one task per file. ``own`` is for files
    of ``sinks.write_csv``: their timestamps are read by Spark's own parser, which is
    faster than one for a pattern and takes other spellings too.
    """
    options = _options(mode, null_value)
    if own:
        del options["timestampNTZFormat"]
    return (spark.read.schema(schema).options(**options)
            .option("header", True).option("multiLine", multi_line).csv(path))


def read_csv_in_splits(spark: SparkSession, path: str, schema: StructType, mode: str = "FAILFAST",
                       null_value: str = "") -> DataFrame:
    """``read_csv(..., multi_line=True)`` with as many tasks as the file has splits."""
    return read_quoted_csv(spark, path, schema, _options(mode, null_value))


# The column that holds the text of a row that cannot be parsed.
REJECTED = "_rejected"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, null_value: str = "",
                     multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): rows that do not fit ``schema`` are kept apart as their text.

    A row is bad when a value cannot be parsed as its type or it has too few or too
    many fields. Rejects have one column, ``REJECTED``. The file is parsed once: the
    parsed rows are written to the shared folder and both results read from there.
    """
    wide = StructType([*schema.fields, StructField(REJECTED, StringType())])
    options = {**_options("PERMISSIVE", null_value), "columnNameOfCorruptRecord": REJECTED}
    if multi_line:
        parsed = read_quoted_csv(spark, path, wide, options)
    else:
        parsed = spark.read.schema(wide).options(**options).option("header", True).csv(path)
    rows = materialize(parsed, "checked")
    good = rows.where(F.col(REJECTED).isNull()).drop(REJECTED)
    return good, rows.where(F.col(REJECTED).isNotNull()).select(REJECTED)


def read_json(spark: SparkSession, path: str, schema: StructType, own: bool = False) -> DataFrame:
    """JSON lines with an explicit schema (``own`` as in ``read_csv``, files of ``sinks.write_json``)."""
    reader = spark.read.schema(schema)
    if not own:
        reader = reader.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset; ``key=value`` directories become partition columns."""
    return spark.read.option("basePath", path).parquet(path)


def raw_csv_inputs(spark: SparkSession, raw_dir: str) -> RawInputs:
    """The nine raw CSV files of a raw folder, typed by ``schemas.RAW_SCHEMAS``."""
    base = raw_dir.rstrip("/")
    frames = {k: (read_csv_in_splits if k in MULTI_LINE else read_csv)(spark, f"{base}/{RAW_FILES[k]}", RAW_SCHEMAS[k])
              for k in RAW_FILES}
    return RawInputs(**frames)
