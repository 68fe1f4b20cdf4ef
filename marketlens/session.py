"""Spark session construction and the shared scratch location.

On a cluster the session is built by the platform; ``get_session`` only fills
in settings that are not already present. Durable intermediate data (the
converted warehouse, round-trip files) goes under ``spark.checkpoint.dir``,
which on a cluster names a shared file system. Where the setting is missing, a
local master gets a private folder (tests); on a cluster that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on, for those that are not set already.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.ui.enabled", "false")
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sc = _context(spark)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        # what the platform or the command line has set stays
        if sc is None or not sc.getConf().contains(k):
            spark.conf.set(k, v)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


MB = 1024 * 1024


def scale_conf(input_bytes: int, cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Sizing for a job reading ``input_bytes`` on ``cores`` task slots.

    * file splits of at most ``target_partition_mb``; Spark itself lowers the
      split to the input spread over the cores (counting a per-file open
      cost), so small inputs still use every core without tiny tasks;
    * shuffle partitions: enough for ~``target_partition_mb`` per partition
      before adaptive coalescing, at least 2 per core;
    * advisory partition size (skew split size and file size of rebalanced
      writes): the input per core, between 8 MB and ``target_partition_mb``;
    * skew threshold at 4x the advisory size;
    * size estimates of Parquet inputs scaled by 4 (its usual compression
      ratio), so the static broadcast decision sees in-memory sizes rather
      than compressed file sizes.
    """
    target = target_partition_mb * MB
    per_core = max(1, input_bytes // max(1, cores))
    advisory = max(8 * MB, min(target, per_core))
    parts = max(2 * cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * advisory),
        "spark.sql.sources.fileCompressionFactor": "4.0",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, cores: int | None = None) -> dict[str, str]:
    """Apply ``scale_conf`` to a running session (SQL settings only)."""
    sc = _context(spark)
    cores = cores or (sc.defaultParallelism if sc is not None else 8)
    conf = scale_conf(input_bytes, cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master (tests) gets a fresh temp folder where the session has
    none. On a cluster each executor would write to its own disk, so a missing
    setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "") or ""
        if not re.match(r"local($|\[)", master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors "
                               f"share (master {master!r})")
        d = tempfile.mkdtemp(prefix="marketlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) one."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared store and read it back: later
    stages read files, keep their size statistics, and survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (cache key for per-session state)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path under the shared folder (never reused, never wiped)."""
    base = shared_dir(spark)
    return "/".join([base, "marketlens", *parts, uuid.uuid4().hex])
