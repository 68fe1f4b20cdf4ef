"""Split CSV with quoted line breaks, bad rows, merges, refreshes, buckets, zone maps, bitmaps."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators.distinct import count_distinct, keep_bitmaps
from marketlens.operators.etl import geo_per_zip
from marketlens.plans import reports as R
from marketlens.plans import roundtrip as RT
from marketlens.sinks import snapshots as S
from marketlens.sources import catalog as C
from marketlens.sources import zonemaps as Z
from marketlens.sources.files import REJECTED, read_csv, read_csv_checked, read_csv_in_splits
from marketlens.sources.records import csv_records
from marketlens.sources.warehouse import Tables

TEXTS = ['plain', 'two\nlines', 'a "quoted" word', '"', '\n\n', 'comma, and\n"both"', 'ends\r\nso', '', 'x' * 300, '\n"\n"\n',
         ' spaces ', "it's"]


def _quoted(v: str) -> str:
    return '"' + v.replace('"', '""') + '"'


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def conf(spark):
    changed = {}

    def set_(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    yield set_
    for key, value in changed.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize("split", ["200", "20k"])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_quoted_line_breaks_in_split_files(spark, conf, tmp_path, split, ending):
    """Equal to the one-task read, from several partitions, wherever the splits fall."""
    rng, expected = random.Random(1), []
    for k in range(2):
        rows = [(i, rng.choice(TEXTS), rng.choice(TEXTS), i % 7) for i in range(k * 1000, k * 1000 + 400)]
        expected += [(i, x or None, y or None, n) for i, x, y, n in rows]  # empty text reads as null here
        lines = [f"{i},{_quoted(x)},{_quoted(y)},{n}" for i, x, y, n in rows]
        with open(tmp_path / f"r{k}.csv", "w", newline="") as f:
            f.write(ending.join(['id,"ti\ntle",body,n', *lines]) + (ending if k else ""))
    path = str(tmp_path)
    schema = spark.createDataFrame([], "id long, title string, body string, n int").schema
    whole = sorted(expected, key=repr)
    if ending == "\n":  # Spark's reader takes the header's line break for the ending
        assert _sorted(read_csv(spark, path, schema, multi_line=True)) == whole
    conf("spark.sql.files.maxPartitionBytes", split)
    conf("spark.sql.files.openCostInBytes", "0")
    got = read_csv_in_splits(spark, path, schema)
    assert len(whole) == 800 and _sorted(got) == whole
    assert csv_records(spark, path).select("file", "split").distinct().count() > 4
    assert csv_records(spark, path).rdd.getNumPartitions() > 1


def test_split_read_of_empty_and_headless_files(spark, tmp_path):
    schema = spark.createDataFrame([], "a long, b string").schema
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b\n")
    assert read_csv_in_splits(spark, str(tmp_path), schema).count() == 0


@pytest.mark.parametrize("multi_line", [False, True])
def test_bad_rows_are_kept_apart(spark, tmp_path, multi_line):
    schema = spark.createDataFrame([], "id long, price double, note string").schema
    bad = ["x,1.0,no number", "3,one,no price", "4,2.0", "5,1.0,a,b"]
    (tmp_path / "p.csv").write_text("\n".join(["id,price,note", "1,1.5,fine", *bad, '2,,"no price, but null"']) + "\n")
    good, rejects = read_csv_checked(spark, str(tmp_path), schema, multi_line=multi_line)
    assert _sorted(good) == [(1, 1.5, "fine"), (2, None, "no price, but null")]
    assert sorted(r[REJECTED] for r in rejects.collect()) == sorted(bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path), schema).collect()


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id long, v string, year int, month int")


def test_merge_keeps_the_rest_of_a_partition(spark):
    rows = [(i, "old", 2017, 1 + i % 2) for i in range(20)] + [(None, "old", 2017, 3), (50, "old", None, None)]
    fq = C.save_managed(_orders(spark, rows), f"{C.new_namespace(spark)}.t", ["year", "month"])
    # half of a month, one key that changes its month and empties it, a null key, a new key, a null partition
    load = [(i, "new", 2017, 1) for i in range(0, 10, 2)] + [(1, "new", 2018, 5), (None, "new", 2017, 4), (99, "new", 2019, 1),
                                                             (50, "new", None, None)]
    for _ in range(2):
        C.merge_by_key(spark, _orders(spark, load), fq, ["order_id"])
        keys = {r[0] for r in load}
        assert _sorted(spark.table(fq)) == sorted([r for r in rows if r[0] not in keys] + load, key=repr)
    assert not [r for r in spark.sql(f"SHOW PARTITIONS {fq}").collect() if "month=3" in r[0]]
    C.merge_by_key(spark, _orders(spark, []), fq, ["order_id"])
    assert spark.table(fq).count() == 23


def test_merge_rewrites_only_touched_partitions(spark):
    rows = [(i, "old", 2017, 1 + i % 4) for i in range(40)]
    fq = C.save_managed(_orders(spark, rows), f"{C.new_namespace(spark)}.t", ["year", "month"])
    files = lambda: {(r.month, r.f) for r in spark.table(fq).select(
        "month", F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    C.merge_by_key(spark, _orders(spark, [(0, "new", 2017, 1)]), fq, ["order_id"])
    after = files()
    assert {x for x in before if x[0] > 1} == {x for x in after if x[0] > 1}
    assert not {x for x in before if x[0] == 1} & after


def test_a_reader_sees_whole_versions(spark, tmp_path):
    root = str(tmp_path / "data")
    with pytest.raises(ValueError):
        S.read_current(spark, root, "orders")
    old = _orders(spark, [(1, "a", 2016, 1), (2, "a", 2017, 1)])
    S.refresh(spark, {"orders": old, "sellers": spark.range(3)}, root)
    reader = S.read_current(spark, root, "orders")
    assert reader.count() == 2

    # a refresh that fails half way leaves the old version current
    broken = spark.range(1).select(F.raise_error(F.lit("stop")).cast("string").alias("x"))
    with pytest.raises(Exception, match="stop"):
        S.refresh(spark, {"orders": old.limit(1), "sellers": broken}, root)
    assert S.read_current(spark, root, "orders").count() == 2 and S.read_current(spark, root, "sellers").count() == 3

    S.refresh(spark, {"orders": _orders(spark, [(3, "b", 2017, 2)]), "sellers": spark.range(5)}, root)
    now = S.read_current(spark, root, "orders")
    assert _sorted(now.select("order_id", "year", "month")) == [(3, 2017, 2)]  # no partition of 2016 left
    assert S.read_current(spark, root, "sellers").count() == 5
    assert reader.count() == 2  # who began on the old version reads on
    assert [r.number for r in S.versions(spark, root).orderBy("number").collect()] == [1, 2]


def test_bucketed_joins_move_no_rows(spark, conf, tables):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    by_order = RT.bucketed_tables(spark, tables, "order_id", 4)
    joined = by_order.reviews.join(by_order.orders, "order_id").select("order_id", "review_score")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = tables.reviews.join(tables.orders, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert plain.count("Exchange hashpartitioning") == 2
    assert _sorted(R.low_reviews(by_order, 2, 20)) == _sorted(R.low_reviews(tables, 2, 20))
    by_customer = RT.bucketed_tables(spark, tables, "customer_id", 4)
    q5 = R.geo_revenue(by_customer)
    plan = q5._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[plan.index("SortMergeJoin"):]
    assert _sorted(q5) == _sorted(R.geo_revenue(tables))


def test_zone_maps_open_only_files_that_can_match(spark, conf, tmp_path):
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 500).alias("w"))
    path = Z.write_clustered(df, str(tmp_path / "with space"), ["w", "id"])
    files = spark.read.parquet(path)
    zones = Z.zone_map(files, {"w": "w"})
    assert zones.agg(F.sum("row_count"), F.sum("w_nulls")).first() == (1000, 100)
    assert zones.count() == len(files.inputFiles()) > 2
    for low, high in ((10, 20), (None, 5), (490, None), (None, None), (600, None)):
        got = Z.read_between(spark, files, path, zones, "w", "w", low, high)
        want = df.where("w IS NOT NULL").where(F.lit(low is None) | (F.col("w") >= (low or 0)))
        want = want.where(F.lit(high is None) | (F.col("w") < (high or 0)))
        assert _sorted(got) == _sorted(want)
    assert 1 <= len(Z.touched_files(zones, "w", 10, 20)) < zones.count() and not Z.touched_files(zones, "w", 600)


def test_bitmaps_merge_to_exact_counts(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(3000)]), rng.choice([1, 1, 1, 2, 3, None]), rng.choice("ab")) for _ in range(9000)]
    df = spark.createDataFrame(rows, "k long, m int, s string")
    kept = keep_bitmaps(df, "k", ["m", "s"])
    for by in (["m"], ["s"], ["m", "s"]):
        want = df.where("k IS NOT NULL").groupBy(*by).agg(F.countDistinct("k").alias("n"))
        assert _sorted(count_distinct(kept, by, "n")) == _sorted(want)
    some = count_distinct(kept.where("m IN (1, 3)"), [], "n").first().n
    assert some == len({k for k, m, _ in rows if m in (1, 3) and k is not None})
    text = df.withColumn("k", F.concat(F.lit("order-"), "k"))  # keys need not be numbers
    assert count_distinct(keep_bitmaps(text, "k", ["m"]), [], "n").first().n == len({k for k, _, _ in rows} - {None})


def test_means_do_not_depend_on_row_order(spark):
    rng = random.Random(4)
    rows = [(7, rng.uniform(-60, 60) * 10 ** rng.randint(-8, 0), rng.uniform(-180, 180)) for _ in range(3000)]
    rows += [(8, float("nan"), 1.0), (8, 2.0, float("inf")), (None, 1.0, 1.0), (9, None, None)]
    schema = "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double"
    first = _sorted(geo_per_zip(spark.createDataFrame(rows, schema)))
    for n in (1, 3, 7):
        rng.shuffle(rows)
        assert _sorted(geo_per_zip(spark.createDataFrame(rows, schema).repartition(n))) == first
    got = {r[0]: r[1:] for r in first}
    assert got["8"] == (2.0, 1.0) and got["9"] == (None, None)
    assert got["7"][0] == pytest.approx(sum(r[1] for r in rows if r[0] == 7) / 3000)


def test_worst_states_are_ranked_before_rounding(spark):
    """Means of 2.001 and 2.0: equal after rounding, the lower one is the worst."""
    n = 1000
    orders = spark.range(2 * n).select(
        F.col("id").alias("order_id"), F.pmod("id", F.lit(2)).alias("customer_id"), F.lit("delivered").alias("order_status"),
        *[F.expr("TIMESTAMP_NTZ '2017-01-01 00:00:00'").alias(c) for c in (
            "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")])
    reviews = spark.range(2 * n).select(F.col("id").alias("order_id"), F.when(F.col("id") == 0, 3).otherwise(2).alias("review_score"))
    customers = spark.createDataFrame([(0, "A"), (1, "B")], "customer_id long, customer_state string")
    t = Tables(orders=orders, products=None, customers=customers, reviews=reviews, sellers=None)
    assert [(r.state, r.avg_review_score) for r in R.worst_review_states(t, 1).collect()] == [("B", 2.0)]
