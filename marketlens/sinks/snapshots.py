"""Full refresh that readers never see half done.

A refresh writes all datasets to a new version folder and names that folder in the
log of versions last. The log is a folder of one-row JSON files; a file appears when its
write commits, whole or not at all. A reader takes the newest entry, so it sees all old or
all new datasets, and one that began on the old version goes on reading it.

Partitions that the new data lacks are not in the new version. A refresh that fails
leaves a folder that nothing names. Old versions stay until a retention rule of the
store removes them. One refresh of a root at a time; of two at once, the later number wins, and
of equal numbers the greater folder name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from marketlens.schemas import LAYOUT
from marketlens.sinks.parquet import write_table

LOG_SCHEMA = "number long, version string"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(number, version) of every committed refresh of ``root``."""
    try:
        return spark.read.schema(LOG_SCHEMA).json(f"{root}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """The newest committed version; none before the first refresh."""
    row = versions(spark, root).orderBy(F.col("number").desc(), F.col("version").desc()).first()
    return None if row is None else (row.number, row.version)


def refresh(spark: SparkSession, frames: dict[str, DataFrame], root: str) -> str:
    """Write ``frames`` as a new version of ``root`` and make it the current one."""
    before = current_version(spark, root)
    version = uuid.uuid4().hex
    for name, df in frames.items():
        layout = LAYOUT.get(name, {"partition_by": [], "codec": "snappy"})
        write_table(df, f"{root}/versions/{version}/{name}", layout["partition_by"], layout["codec"])
    number = 1 if before is None else before[0] + 1
    spark.createDataFrame([(number, version)], LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/log")
    return version


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Dataset ``name`` of the current version."""
    now = current_version(spark, root)
    if now is None:
        raise ValueError(f"{root} has no version yet")
    path = f"{root}/versions/{now[1]}/{name}"
    return spark.read.option("basePath", path).parquet(path)
