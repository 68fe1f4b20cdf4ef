"""What jobs write and move: text copies, files and shuffles bounded by the rows."""

from __future__ import annotations


import hashlib
import os

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from marketlens.plans import measure as M
from marketlens.plans import reports as R
from marketlens.plans import roundtrip as RT
from marketlens.sinks import parquet as P
from marketlens.sources import catalog as C
from marketlens.sources import warehouse as W
from marketlens.sources.files import read_csv, read_json
from marketlens.sources.testdata import raw_inputs


def _sizes(spark, path):
    return {r.path: r.length for r in M.list_files(spark, path).collect()}


def test_text_copies_are_compressed_into_files_of_bounded_rows(spark, tables, monkeypatch, tmp_path):
    monkeypatch.setattr(P, "TEXT_ROWS", 1000)
    at = {}
    monkeypatch.setattr(M, "format_copies", lambda *a, made=M.format_copies, **k: at.update(made(*a, **k)) or dict(at))
    digests = M.format_equality(spark, tables, 1997, 10).collect()
    assert len(digests) == 9 and len({r.digest for r in digests if r["read"] == "full"}) == 1
    n = tables.orders.count()
    for kind, write in (("csv", P.write_csv), ("json", P.write_json)):
        copies = _sizes(spark, at[kind])
        assert all(f.endswith(f".{kind}.gz") for f in copies if f".{kind}" in f)
        assert sum(f".{kind}" in f for f in copies) >= n // 1000
        assert sum(copies.values()) * 4 < sum(_sizes(spark, write(tables.orders, str(tmp_path / kind))).values())


def test_text_round_trips_are_compressed_and_whole(spark, tables):
    for back in (RT.json_roundtrip(spark, tables.orders), RT.csv_roundtrip(spark, tables.orders),
                 RT.csv_roundtrip(spark, tables.reviews, multi_line=True)):
        assert all(f.endswith(".gz") for f in back.inputFiles())
        was = tables.orders if "price" in back.columns else tables.reviews
        assert back.exceptAll(was).count() == 0 and back.count() == was.count()


def test_a_query_converts_only_the_tables_it_reads(spark, tmp_path):
    """Each once, whatever asks for it; the folder is named when it is whole."""
    out = str(tmp_path / "w")
    t = W.converted_on_demand(spark, raw_inputs(spark, "/root/testdata/sf0.001"), out)
    made = lambda: set(os.listdir(out)) if os.path.isdir(out) else set()
    assert made() == set()
    assert t.reviews.count() > 0 and made() == {"reviews"}
    assert t.products_flat.count() > 0 and made() == {"reviews", "products"}
    before = sorted(_sizes(spark, f"{out}/reviews"))
    assert t.root == out and made() == set(W.TABLES)
    assert sorted(_sizes(spark, f"{out}/reviews")) == before and t.reviews is t.as_dict()["reviews"]
    with pytest.raises(AttributeError):
        t.no_such_table


def test_a_table_that_fails_to_convert_is_tried_again(spark):
    calls = []

    def make():
        calls.append(1)
        if len(calls) == 1:
            raise ValueError("first")
        return spark.range(1)
    t = W.TablesOnDemand(dict.fromkeys(W.TABLES, make), lambda: None)
    with pytest.raises(ValueError):
        t.orders
    assert t.orders.count() == 1 and len(calls) == 2


def test_buckets_follow_the_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(RT, "BUCKET_ROWS", 100)
    t = RT.bucketed_tables(spark, tables, "customer_id")
    want = -(-tables.orders.count() // 100)
    for name in ("orders", "customers"):
        files = getattr(t, name).inputFiles()
        numbers = {int(f.rsplit("_", 1)[1].split(".")[0]) for f in files}
        assert want > 30 and max(numbers) > want // 2 and max(numbers) < want
    assert R.geo_revenue(t).collect() == R.geo_revenue(tables).collect()


def _rebalanced(monkeypatch):
    asked, kind = [], DataFrame
    plain = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *a: asked.append(name) or plain(self, name, *a))
    return asked


def test_rows_that_lie_by_partition_are_not_moved_again(spark, tables, monkeypatch):
    """Loads and merges of orders read from their own layout: whole, few files, no second shuffle of the rows."""
    fq = C.save_managed(tables.orders, f"{C.new_namespace(spark)}.orders", ["year", "month"])
    partitions = tables.orders.select("year", "month").distinct().count()
    asked = _rebalanced(monkeypatch)
    C.insert_idempotent(spark, tables.orders, fq)
    C.merge_by_key(spark, tables.orders.where("order_id % 2 = 0"), fq, ["order_id"])
    assert asked == [] and len(spark.table(fq).inputFiles()) <= 5 * partitions
    out = spark.table(fq).select(tables.orders.columns)
    assert out.count() == tables.orders.count() and out.exceptAll(tables.orders).count() == 0


def test_scattered_loads_are_still_rebalanced(spark, monkeypatch):
    rows = spark.range(4000, numPartitions=16).selectExpr("id AS order_id", "2017 AS year", "CAST(id % 3 AS INT) AS month")
    fq = C.save_managed(rows, f"{C.new_namespace(spark)}.t", ["year", "month"])
    asked = _rebalanced(monkeypatch)
    C.insert_idempotent(spark, rows, fq)
    assert asked == ["rebalance"] and len(spark.table(fq).inputFiles()) == 3 and spark.table(fq).count() == 4000


def test_merge_of_many_rows_finds_each_by_its_place(spark):
    """More rows in a file than one bitmap holds, keys that come twice or are null."""
    n = 80_000
    rows = spark.range(n).selectExpr("IF(id % 1000 = 999, NULL, id DIV 2) AS order_id", "'old' AS v", "2017 AS year", "1 AS month")
    fq = C.save_managed(rows.coalesce(1), f"{C.new_namespace(spark)}.t", ["year", "month"])
    load = spark.range(0, n // 2, 7).selectExpr("id AS order_id", "'new' AS v", "2017 AS year", "1 AS month")
    C.merge_by_key(spark, load, fq, ["order_id"])
    want = rows.where("order_id IS NULL OR order_id % 7 <> 0").unionByName(load)
    got = spark.table(fq).select(rows.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_row_of_the_digest_is_worked_out_once(spark):
    """One MD5 in the generated code (a sum of decimals had two), and the sum that hashlib gives."""
    aside = spark.newSession()
    aside.conf.set("spark.sql.adaptive.enabled", "false")
    rows = [(i, None if i % 7 == 0 else f"v{i}") for i in range(500)]
    df = aside.createDataFrame(rows, "a int, b string")
    assert M.plan_text(M.rows_digest(aside.range(9).selectExpr("id AS a"), ["a"]), "codegen").count("md5Hex") == 1
    texts = ["|".join("~" if v is None else str(v) for v in r) for r in rows]
    want = sum(int(hashlib.md5(t.encode()).hexdigest()[:12], 16) for t in texts)
    assert M.rows_digest(df, ["a", "b"]).first() == (500, str(want))
    assert M.rows_digest(df.limit(0), ["a", "b"]).first() == (0, "0")


def test_parquet_copy_of_a_dataset_is_not_moved(spark, tables, monkeypatch):
    """Whole, with as few files as the dataset; what is not the dataset itself is rebalanced."""
    asked, orders = _rebalanced(monkeypatch), tables.orders
    for df, moves in ((orders, 0), (orders.where("order_id % 2 = 0"), 1)):
        del asked[:]
        copy = spark.read.parquet(M.format_copies(spark, df, stored=tables.path("orders"))["parquet"])
        assert asked == ["rebalance"] * moves and len(copy.inputFiles()) <= 2 * len(orders.inputFiles())
        assert copy.count() == df.count() and copy.select(df.columns).exceptAll(df).count() == 0
    monkeypatch.undo()
    assert W.derived_tables(raw_inputs(spark, "/root/testdata/sf0.001")).path("orders") is None


def test_text_reads_of_a_month_are_filtered_while_parsed(spark, tables, tmp_path):
    P.write_csv(tables.orders, str(tmp_path / "csv"))
    P.write_json(tables.orders, str(tmp_path / "json"))
    for df in (read_csv(spark, str(tmp_path / "csv"), tables.orders.schema, null_value=P.CSV_NULL, own=True),
               read_json(spark, str(tmp_path / "json"), tables.orders.schema, own=True)):
        for year, month in ((1997, 10), (1997, 12), (1996, 2)):
            month_of = df.where(M._of_month(year, month))
            assert "GreaterThanOrEqual(order_purchase_timestamp" in M.plan_text(month_of)
            want = tables.orders.where(f"year = {year} AND month = {month}")
            assert month_of.count() == want.count() > 0 and month_of.exceptAll(want).count() == 0


def test_own_text_files_give_back_odd_timestamps(spark, tmp_path):
    """Spark's own parser reads what the pattern wrote: microseconds, early and late years, null."""
    times = ["0001-01-01 00:00:00", "1582-10-10 12:00:00", "1969-12-31 23:59:59.999999", "1997-10-01 00:00:00.000001",
             "9999-12-31 23:59:59.999999", "+10000-01-01 00:00:00", "-0044-03-15 01:02:03", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string").selectExpr(
        "i", "CAST(t AS TIMESTAMP_NTZ) AS t")
    P.write_csv(df, str(tmp_path / "csv"), codec="gzip", level="THREE")
    P.write_json(df, str(tmp_path / "json"), codec="gzip", level="THREE")
    want = sorted(map(tuple, df.selectExpr("i", "CAST(t AS STRING)").collect()))
    for back in (read_csv(spark, str(tmp_path / "csv"), df.schema, null_value=P.CSV_NULL, own=True),
                 read_json(spark, str(tmp_path / "json"), df.schema, own=True)):
        assert sorted(map(tuple, back.selectExpr("i", "CAST(t AS STRING)").collect())) == want
        assert all(f.endswith(".gz") for f in back.inputFiles())


def test_the_level_of_compressed_text_is_the_one_asked_for(spark, tables, tmp_path):
    for write in (P.write_csv, P.write_json):
        fast, best = (sum(_sizes(spark, write(tables.orders, str(tmp_path / f"{write.__name__}-{level}"), codec="gzip",
                                              level=level)).values()) for level in ("BEST_SPEED", "BEST_COMPRESSION"))
        assert fast > 1.1 * best
