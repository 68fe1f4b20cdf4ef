"""Raw files in parts, the shared folder, and loads into catalog tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketlens.schemas import RAW_SCHEMAS
from marketlens.session import shared_dir
from marketlens.sources import catalog as C
from marketlens.sources.files import MULTI_LINE, read_csv


def test_large_csv_file_is_split(spark, tmp_path):
    path = str(tmp_path / "items.csv")
    schema = RAW_SCHEMAS["items"]
    row = ["o1,1,p1,s1,2017-01-01 00:00:00,1.25,0.5"]
    with open(path, "w") as f:
        f.write(",".join(schema.fieldNames()) + "\n" + "\n".join(row * 40_000) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = read_csv(spark, path, schema)
        per_task = df.groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) > 1 and sum(r["count"] for r in per_task) == 40_000
        assert MULTI_LINE == {"reviews"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("remote")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_external_table_follows_its_new_folder(spark, tmp_path):
    db = C.new_namespace(spark)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    spark.range(9).write.parquet(b)
    assert spark.table(C.register_external(spark, db, "t", a)).count() == 3
    assert spark.table(C.register_external(spark, db, "t", b)).count() == 9
    assert spark.table(C.register_external(spark, db, "t", b + "/")).count() == 9
    C.save_managed(spark.range(2).toDF("x"), f"{db}.m")
    with pytest.raises(ValueError, match="no external table"):
        C.register_external(spark, db, "m", a)


def test_inserts_write_few_files_and_no_nan(spark):
    db = C.new_namespace(spark)
    rows = spark.range(4000).repartition(16).select(
        (F.col("id") % 5).alias("v"), F.when(F.col("id") % 2 == 0, float("nan")).otherwise(1.0).alias("price"),
        (F.col("id") % 10).cast("int").alias("month"))
    fq = C.save_managed(rows.limit(0), f"{db}.t", ["month"])
    C.insert_append(rows, fq)
    assert len(spark.table(fq).inputFiles()) <= 20
    assert spark.table(fq).where("isnan(price)").count() == 0 and spark.table(fq).where("price IS NULL").count() == 2000
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for _ in range(2):
        C.insert_idempotent(spark, rows.where("month < 3"), fq)
    spark.catalog.refreshTable(fq)
    assert spark.table(fq).count() == 4000 and len(spark.table(fq).inputFiles()) <= 20
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_cli_writes_the_whole_result(tables, tmp_path, capsys, spark):
    from marketlens.cli import _deliver
    from marketlens.plans import reports as R

    whole = R.geo_revenue(tables)
    _deliver(whole, str(tmp_path / "q5"), None)
    assert spark.read.json(str(tmp_path / "q5")).count() == whole.count()
    _deliver(whole, None, 2)
    assert "only 2 rows are shown" in capsys.readouterr().out
