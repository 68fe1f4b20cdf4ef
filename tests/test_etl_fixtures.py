"""Golden conversion test: nine small raw CSV files → five datasets.

The fixture rows follow FIXTURES.md §1 (an order with two items, one without
items, one not delivered; two payments of different type, an order without
payment; null / multi-line review text; null and untranslated categories;
ZIP ``01310``; a ZIP with three coordinates and one with none).
"""

from __future__ import annotations

import os

import pytest

from marketlens.operators.etl import convert_all
from marketlens.plans.measure import dataset_checks
from marketlens.schemas import RAW_FILES
from marketlens.sources.files import raw_csv_inputs
from marketlens.sources.warehouse import Tables, build_warehouse, open_tables

CSV = {
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00
o2,c2,delivered,2018-07-24 20:41:37,2018-07-26 03:24:27,2018-07-26 14:31:00,2018-08-07 15:27:45,2018-08-13 00:00:00
o3,c3,shipped,2018-08-08 08:38:49,2018-08-08 08:55:23,2018-08-08 13:50:00,,2018-09-04 00:00:00
o4,c1,delivered,2017-11-18 19:28:06,2017-11-18 19:45:59,2017-11-22 13:39:59,2017-12-02 00:28:42,2017-12-15 00:00:00
""",
    "items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72
o1,2,p2,s1,2017-10-06 11:07:15,10.00,2.50
o2,1,p3,s2,2018-07-30 03:24:27,118.70,22.76
o4,1,p1,s1,2017-11-23 19:45:59,45.00,12.79
""",
    "payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,2,voucher,1,2.00
o1,1,credit_card,3,47.21
o2,1,boleto,1,141.46
o4,1,credit_card,2,57.79
""",
    "reviews": """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,4,,,2017-10-11 00:00:00,2017-10-12 03:43:48
r2,o2,1,ruim,"Produto ""quebrado""
chegou tarde",2018-08-08 00:00:00,2018-08-08 18:37:50
r3,o4,5,,otimo,2017-12-03 00:00:00,2017-12-05 19:45:42
r4,o4,2,,ok,2017-12-04 00:00:00,2017-12-06 10:00:00
r5,o3,3,,,2018-08-20 00:00:00,2018-08-21 00:00:00
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,perfumaria,40,287,1,225,16,10,14
p2,,44,276,1,,30,18,20
p3,categoria_nova,46,250,1,5000,25,15,20
p4,perfumaria,48,300,2,6000,NaN,10,10
""",
    "categories": """product_category_name,product_category_name_english
perfumaria,perfumery
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01310,sao paulo,SP
c2,u2,14409,franca,SP
c3,u3,99999,nowhere,RS
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,14409,franca,SP
s2,01310,sao paulo,SP
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01310,-23.5,-46.6,sao paulo,SP
01310,-23.6,-46.7,sao paulo,SP
01310,-23.7,-46.8,sao paulo,SP
14409,-20.5,-47.4,franca,SP
""",
}


@pytest.fixture(scope="module")
def converted(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    for key, text in CSV.items():
        (raw / RAW_FILES[key]).write_text(text)
    out = str(tmp_path_factory.mktemp("parquet") / "wh")
    inputs = raw_csv_inputs(spark, str(raw))
    build_warehouse(inputs, out)
    return open_tables(spark, out), Tables(**convert_all(inputs))


def test_orders_item_grain_and_itemless_order(converted):
    t, _ = converted
    rows = {(r.order_id, r.order_item_id) for r in t.orders.collect()}
    assert rows == {("o1", 1), ("o1", 2), ("o2", 1), ("o3", None), ("o4", 1)}
    o3 = t.orders.where("order_id = 'o3'").first()
    assert o3.price is None and o3.order_delivered_customer_date is None
    assert dict(t.orders.dtypes)["order_item_id"] == "int"


def test_payments_first_by_sequence_max_and_sum(converted):
    t, _ = converted
    o1 = t.orders.where("order_id = 'o1'").select("payment_type", "payment_installments",
                                                  "payment_value").distinct().collect()
    assert len(o1) == 1
    assert (o1[0].payment_type, o1[0].payment_installments, o1[0].payment_value) == ("credit_card", 3, 49.21)
    o3 = t.orders.where("order_id = 'o3'").first()
    assert o3.payment_type is None and o3.payment_value is None


def test_year_month_partitions(converted):
    t, _ = converted
    got = {(r.year, r.month) for r in t.orders.select("year", "month").distinct().collect()}
    assert got == {(2017, 10), (2017, 11), (2018, 7), (2018, 8)}
    assert sorted(d for d in os.listdir(t.root + "/orders") if d.startswith("year=")) == [
        "year=2017", "year=2018"]


def test_reviews_text_filled_and_multiline_parsed(converted):
    t, _ = converted
    r = {x.review_id: x for x in t.reviews.collect()}
    assert r["r1"].review_comment_message == "" and r["r1"].review_comment_title == ""
    assert r["r2"].review_comment_message == 'Produto "quebrado"\nchegou tarde'
    assert sorted(d for d in os.listdir(t.root + "/reviews") if d.startswith("review_score=")) == [
        f"review_score={i}" for i in range(1, 6)]


def test_products_structs_null_category_and_nan(converted):
    t, _ = converted
    p = {x.product_id: x for x in t.products_flat.collect()}
    assert p["p1"].category_english == "perfumery"
    assert p["p2"].category_portuguese is None and p["p2"].category_english is None and p["p2"].weight_g is None
    assert p["p3"].category_portuguese == "categoria_nova" and p["p3"].category_english is None
    assert p["p4"].length_cm is None  # NaN in the file is stored as NULL
    assert [f.name for f in t.products.schema["dimensions"].dataType.fields] == [
        "weight_g", "length_cm", "height_cm", "width_cm"]


def test_zip_prefix_loses_leading_zero_on_both_sides(converted):
    t, _ = converted
    c = {x.customer_id: x for x in t.customers.collect()}
    assert c["c1"].customer_zip_code_prefix == "1310"
    assert c["c1"].geolocation_lat == pytest.approx(-23.6) and c["c1"].geolocation_lng == pytest.approx(-46.7)
    assert c["c3"].geolocation_lat is None
    s = {x.seller_id: x for x in t.sellers.collect()}
    assert s["s2"].geolocation_lat == pytest.approx(-23.6)


def test_written_equals_lazy(converted):
    t, lazy = converted
    for name in ("orders", "customers", "reviews", "sellers"):
        a, b = t.as_dict()[name], lazy.as_dict()[name]
        cols = sorted(b.columns)
        assert a.select(cols).exceptAll(b.select(cols)).count() == 0
        assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_dataset_checks_all_pass(spark, converted):
    t, _ = converted
    checks = dataset_checks(spark, t, min_rows={"orders": 4, "customers": 2}, review_partitions=5).collect()
    failed = [c for c in checks if not c.ok]
    assert not failed, failed


def test_full_refresh_is_idempotent(spark, converted, tmp_path):
    t, lazy = converted
    out = str(tmp_path / "again")
    from marketlens.sinks.parquet import write_table

    for _ in range(2):
        write_table(lazy.orders, out, ["year", "month"], "snappy")
    assert spark.read.parquet(out).count() == t.orders.count()


def test_bad_timestamp_fails_fast(spark, tmp_path):
    from marketlens.schemas import RAW_SCHEMAS
    from marketlens.sources.files import read_csv

    p = tmp_path / "bad.csv"
    p.write_text(CSV["orders"].replace("2017-10-02 10:56:33", "not a time"))
    with pytest.raises(Exception):
        read_csv(spark, str(p), RAW_SCHEMAS["orders"]).collect()
