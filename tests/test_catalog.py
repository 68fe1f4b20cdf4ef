"""Catalog tables: external + partition repair, managed loads, idempotency."""

from __future__ import annotations

from marketlens.plans import roundtrip as RT
from marketlens.sources import catalog as C


def test_external_table_needs_partition_repair(spark, tables):
    db = C.new_namespace(spark)
    fq = f"{db}.orders_raw"
    spark.sql(f"CREATE TABLE {fq} USING parquet LOCATION '{tables.root}/orders'")
    assert spark.table(fq).count() == 0  # partitions not registered yet
    spark.sql(f"MSCK REPAIR TABLE {fq} SYNC PARTITIONS")
    assert spark.table(fq).count() == tables.orders.count()
    assert "orders_raw" in C.list_tables(spark, db)


def test_register_warehouse_all_tables(spark, tables):
    db = C.new_namespace(spark)
    names = C.register_warehouse(spark, db, tables.root)
    assert sorted(names) == ["customers", "orders", "products", "reviews", "sellers"]
    for name, fq in names.items():
        assert spark.table(fq).count() == tables.as_dict()[name].count()


def test_plain_append_doubles_idempotent_load_does_not(spark, tables):
    db = C.new_namespace(spark)
    fq = C.save_managed(tables.orders, f"{db}.orders", ["year", "month"])
    n = tables.orders.count()
    C.insert_idempotent(spark, tables.orders, fq)
    C.insert_idempotent(spark, tables.orders, fq)
    assert spark.table(fq).count() == n
    C.insert_append(tables.orders.select(spark.table(fq).columns), fq)
    assert spark.table(fq).count() == 2 * n


def test_idempotent_reload_restores_whole_table(spark, tables):
    out = RT.idempotent_reload(spark, tables)
    assert out.count() == tables.orders.count()
    assert out.exceptAll(tables.orders.select(out.columns)).count() == 0


def test_schema_catalogue_lists_struct_fields_and_partitions(spark, tables):
    cat = {(r.table_name, r.column_name): r for r in C.schema_catalogue(spark, tables.as_dict()).collect()}
    assert cat[("orders", "year")].is_partition and not cat[("orders", "price")].is_partition
    assert cat[("products", "dimensions.weight_g")].is_subfield
    assert cat[("products", "category")].data_type.startswith("struct<")
