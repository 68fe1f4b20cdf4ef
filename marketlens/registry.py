"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and SQL twins.

Parameters are chosen for the driver's test data (orders span 1995–2001, so
the year-based reports use 1996/1997 where the modelled system used
2017/2018; the HAVING floor of Q6 is a parameter because a state has only a
handful of reviewed orders at small scale factors).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens import oracle
from marketlens.operators import similarity as SIM
from marketlens.operators.distinct import count_distinct
from marketlens.operators.etl import payments_per_order, products_flat
from marketlens.plans import measure as M
from marketlens.plans import reports as R
from marketlens.plans import roundtrip as RT
from marketlens.sources.testdata import raw_inputs, read_table
from marketlens.sources.warehouse import tables_for

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters for the test data.
Q1_YEARS = (1996, 1997)
Q6_MIN_ORDERS = 3
ONE_YEAR = 1997
QUARTER = (1997, 4)
CITY = "HOUSEHOLD"
SIM_TOP_N = 10          # the similarity command line asks for 10
# Partition minimums of the dataset checks (year and month; scores).
MIN_PARTITIONS = {"orders": 2, "reviews": 2}
SPOILT_EVERY = 7        # every 7th order's payments are written with bad text
ZONE = ("1997-03-10", "1997-03-25")
LIGHT = 1500.0
UNKNOWN_ID = -1         # no product has a negative id


def _on_tables(report, **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(tables_for(spark, sf_dir), **params)
    run.__name__ = report.__name__
    run.__doc__ = report.__doc__
    return run


def _adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL text over the registered tables (the post-load sample query)."""
    return R.run_sql(spark, tables_for(spark, sf_dir), R.SAMPLE_SQL)


def _features(t):
    """The feature table, materialised once per snapshot (re-read by subqueries)."""
    return SIM.feature_table(t)


def _top_n(t):
    """Products most similar to the most ordered product (SIM4 with SIM5's pick)."""
    feats = _features(t)
    return SIM.similar_products(SIM.scaled_table(t), SIM.most_popular_id(feats), SIM_TOP_N)


def _with(fn) -> Query:
    """Register ``fn(spark, tables)`` as a query over the converted tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, tables_for(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    "q1_revenue_trend": _on_tables(R.revenue_trend, years=Q1_YEARS),
    "q2_top_categories": _on_tables(R.top_categories, max_weight=5000, limit=15),
    "q2n_top_categories_nested": _on_tables(R.top_categories_nested, max_weight=5000, limit=15),
    "q3_cohort_retention": _on_tables(R.cohort_retention),
    "q4_low_reviews": _on_tables(R.low_reviews, max_score=2, limit=20),
    "q5_geo_revenue": _on_tables(R.geo_revenue),
    "q6_delivery_vs_reviews": _on_tables(R.delivery_vs_reviews, min_orders=Q6_MIN_ORDERS),
    "q7_top_states": _on_tables(R.top_states, limit=5),
    "q8_one_year": _on_tables(R.one_year, year=ONE_YEAR),
    "n1_top_categories": _on_tables(R.top_categories_by_revenue, k=5),
    "n2_revenue_by_year": _on_tables(R.revenue_by_year, years=Q1_YEARS),
    "n3_payment_share": _on_tables(R.payment_share),
    "n4_worst_review_states": _on_tables(R.worst_review_states, k=5),
    "n5_one_star_categories": _on_tables(R.one_star_categories, k=5),
    "n6_top_categories_quarter_city": _on_tables(R.top_categories_in_quarter, year=QUARTER[0],
                                                 quarter=QUARTER[1], city=CITY, k=5),
    "n6_top_categories_quarter": _on_tables(R.top_categories_in_quarter, year=QUARTER[0],
                                            quarter=QUARTER[1], city=None, k=5),
    "n7_top_categories_year": _on_tables(R.top_categories_in_year, year=ONE_YEAR, k=5),
    "n8_states_quarter": _on_tables(R.states_by_orders_in_quarter, year=QUARTER[0],
                                    quarter=QUARTER[1], k=5),
    "adhoc_sql": _adhoc,
    # converted tables (ETL1-ETL5, VW1) and the per-order payment aggregate
    "etl_orders_wide": _with(lambda s, t: t.orders),
    "etl_products_flat": _with(lambda s, t: t.products_flat),
    "etl_customers": _with(lambda s, t: t.customers),
    "etl_reviews": _with(lambda s, t: t.reviews),
    "etl_sellers": _with(lambda s, t: t.sellers),
    "etl_payments_per_order": lambda s, d: payments_per_order(raw_inputs(s, d).payments),
    # sources and sinks
    "src_csv_roundtrip": _with(lambda s, t: RT.csv_roundtrip(s, t.reviews, multi_line=True)),
    "src_csv_projected": _with(lambda s, t: RT.csv_projected(s, t.orders)),
    "src_csv_prefix_filter": _with(lambda s, t: RT.csv_prefix_filter(
        s, t.orders, "order_purchase_timestamp", f"{ONE_YEAR}-10")),
    "src_json_roundtrip": _with(lambda s, t: RT.json_roundtrip(s, t.orders)),
    "src_parquet_partition_filter": _with(lambda s, t: RT.parquet_partition_filter(t, ONE_YEAR, 10)),
    "src_parquet_projected": _with(lambda s, t: RT.parquet_projected(t)),
    # catalog tables
    "tbl_external": _with(lambda s, t: s.table(RT.external_tables(s, t)["orders"])),
    "tbl_managed": _with(lambda s, t: RT.managed_table(s, t.reviews, "reviews")),
    "tbl_managed_orders": _with(lambda s, t: RT.managed_load(s, t, "orders")),
    "tbl_managed_products": _with(lambda s, t: products_flat(RT.managed_load(s, t, "products"))),
    "tbl_managed_customers": _with(lambda s, t: RT.managed_load(s, t, "customers")),
    "tbl_managed_sellers": _with(lambda s, t: RT.managed_load(s, t, "sellers")),
    "tbl_append": _with(lambda s, t: RT.plain_append(s, t)),
    "tbl_append_idempotent": _with(lambda s, t: RT.idempotent_reload(s, t)),
    "cat_overview": _with(lambda s, t: R.overview(t)),
    # whole-day spans on sub-day timestamps
    "days_between_events": lambda s, d: RT.event_spans(read_table(s, d, "events")),
    # product similarity
    "sim_features": _with(lambda s, t: SIM.product_features(t)),
    "sim_scaled": _with(lambda s, t: SIM.scale_features(_features(t))),
    "sim_popular": _with(lambda s, t: SIM.popular_products(SIM.product_features(t), 10)),
    "sim_top_n": _with(lambda s, t: _top_n(t)),
    "sim_target": _with(lambda s, t: SIM.target_product(SIM.scaled_table(t), SIM.most_popular_id(_features(t)))),
    "sim_unknown_id": _with(lambda s, t: SIM.find_similar(SIM.scaled_table(t), UNKNOWN_ID, SIM_TOP_N)),
    "sim_embeddings": lambda s, d: SIM.similar_embeddings(read_table(s, d, "embeddings"), SIM_TOP_N),
    # what filters read, and data quality (file sizes and timings: bench.py)
    "msr_pruning": _with(lambda s, t: M.pruned_rows(
        t.orders, RT.parquet_partition_filter(t, ONE_YEAR, 10), ["year", "month"])),
    "msr_pruning_reviews": _with(lambda s, t: M.pruned_rows(
        t.reviews, t.reviews.where("review_score <= 2"), ["review_score"])),
    "dq_checks": lambda s, d: M.table_checks(tables_for(s, d), M.raw_minimums(raw_inputs(s, d)), MIN_PARTITIONS),
    # split files with quoted line breaks, bad rows kept apart, formats proved equal
    "src_csv_split_reviews": _with(lambda s, t: RT.csv_split_roundtrip(s, t.reviews)),
    "src_csv_rejects": lambda s, d: RT.csv_good_and_bad(s, raw_inputs(s, d).payments, SPOILT_EVERY),
    "msr_formats": _with(lambda s, t: M.format_equality(s, t, ONE_YEAR, 10)),
    # keyed merge, whole refresh, files named by zone maps
    "tbl_merge": _with(lambda s, t: RT.merged_reload(s, t)),
    "snk_refresh": _with(lambda s, t: RT.refreshed(s, t)),
    "msr_zone_orders": _with(lambda s, t: RT.zone_pruned_orders(s, t, *ZONE)),
    "msr_zone_products": _with(lambda s, t: RT.zone_pruned_products(s, t, LIGHT)),
    # joins of bucketed tables
    "q4_low_reviews_bucketed": _with(lambda s, t: R.low_reviews(RT.bucketed_tables(s, t, "order_id"), 2, 20)),
    "q5_geo_revenue_bucketed": _with(lambda s, t: R.geo_revenue(RT.bucketed_tables(s, t, "customer_id"))),
    "q6_delivery_vs_reviews_bucketed": _with(lambda s, t: R.delivery_vs_reviews(
        RT.bucketed_tables(s, t, "order_id"), min_orders=Q6_MIN_ORDERS)),
    # distinct counts merged from bitmaps
    "agg_distinct_orders_month": _with(lambda s, t: count_distinct(
        RT.order_bitmaps(t, "order_id"), ["year", "month"], "total_orders")),
    "agg_distinct_states_quarter": _with(lambda s, t: count_distinct(
        RT.order_bitmaps(t, "order_id").where(f"year = {QUARTER[0]} AND quarter(make_date(year, month, 1)) = {QUARTER[1]}"),
        ["customer_state"], "order_count")),
    "agg_distinct_customers_year": _with(lambda s, t: count_distinct(
        RT.order_bitmaps(t, "customer_id"), ["year"], "customers")),
}

ORACLE: dict[str, str] = {
    "q1_revenue_trend": oracle.q1(Q1_YEARS),
    "q2_top_categories": oracle.q2(5000, 15),
    "q2n_top_categories_nested": oracle.q2(5000, 15),
    "q3_cohort_retention": oracle.q3(),
    "q4_low_reviews": oracle.q4(2, 20),
    "q5_geo_revenue": oracle.q5(),
    "q6_delivery_vs_reviews": oracle.q6(Q6_MIN_ORDERS),
    "q7_top_states": oracle.q7(5),
    "q8_one_year": oracle.q8(ONE_YEAR),
    "n1_top_categories": oracle.n1(5),
    "n2_revenue_by_year": oracle.n2(Q1_YEARS),
    "n3_payment_share": oracle.n3(),
    "n4_worst_review_states": oracle.n4(5),
    "n5_one_star_categories": oracle.n5(5),
    "n6_top_categories_quarter_city": oracle.n6(QUARTER[0], QUARTER[1], CITY, 5),
    "n6_top_categories_quarter": oracle.n6(QUARTER[0], QUARTER[1], None, 5),
    "n7_top_categories_year": oracle.n7(ONE_YEAR, 5),
    "n8_states_quarter": oracle.n8(QUARTER[0], QUARTER[1], 5),
    "adhoc_sql": oracle.adhoc(),
    "etl_orders_wide": oracle.table("m_orders"),
    "etl_products_flat": oracle.table("m_products_flat"),
    "etl_customers": oracle.table("m_customers"),
    "etl_reviews": oracle.table("m_reviews"),
    "etl_sellers": oracle.table("m_sellers"),
    "etl_payments_per_order": oracle.payments_per_order(),
    "src_csv_roundtrip": oracle.table("m_reviews"),
    "src_csv_projected": oracle.table("m_orders", cols="order_id, order_status"),
    "src_csv_prefix_filter": oracle.table(
        "m_orders", f"CAST(order_purchase_timestamp AS VARCHAR) LIKE '{ONE_YEAR}-10%'"),
    "src_json_roundtrip": oracle.table("m_orders"),
    "src_parquet_partition_filter": oracle.table("m_orders", f"year = {ONE_YEAR} AND month = 10"),
    "src_parquet_projected": oracle.table("m_orders", cols="order_id, order_status"),
    "tbl_external": oracle.table("m_orders"),
    "tbl_managed": oracle.table("m_reviews"),
    "tbl_managed_orders": oracle.table("m_orders"),
    "tbl_managed_products": oracle.table("m_products_flat"),
    "tbl_managed_customers": oracle.table("m_customers"),
    "tbl_managed_sellers": oracle.table("m_sellers"),
    "tbl_append": oracle.appended("m_sellers", 2),
    "tbl_append_idempotent": oracle.table("m_orders"),
    "cat_overview": oracle.overview(),
    "msr_pruning": oracle.pruned_rows("m_orders", f"year = {ONE_YEAR} AND month = 10", "year, month"),
    "msr_pruning_reviews": oracle.pruned_rows("m_reviews", "review_score <= 2", "review_score"),
    "dq_checks": oracle.table_checks(MIN_PARTITIONS),
    "src_csv_split_reviews": oracle.table("m_reviews"),
    "src_csv_rejects": oracle.split_good_bad(SPOILT_EVERY),
    "msr_formats": oracle.format_reads(ONE_YEAR, 10),
    "tbl_merge": oracle.table("m_orders"),
    "snk_refresh": oracle.table("m_orders"),
    "msr_zone_orders": oracle.table("m_orders", f"order_purchase_timestamp >= TIMESTAMP '{ZONE[0]}' "
                                                f"AND order_purchase_timestamp < TIMESTAMP '{ZONE[1]}'"),
    "msr_zone_products": oracle.table("m_products_flat", f"weight_g < {LIGHT}"),
    "q4_low_reviews_bucketed": oracle.q4(2, 20),
    "q5_geo_revenue_bucketed": oracle.q5(),
    "q6_delivery_vs_reviews_bucketed": oracle.q6(Q6_MIN_ORDERS),
    "agg_distinct_orders_month": oracle.distinct_by("order_id", "o.year, o.month", "TRUE", "total_orders"),
    "agg_distinct_states_quarter": oracle.distinct_by(
        "order_id", "c.customer_state", f"o.year = {QUARTER[0]} AND quarter(o.order_purchase_timestamp) = {QUARTER[1]}",
        "order_count"),
    "agg_distinct_customers_year": oracle.distinct_by("customer_id", "o.year", "TRUE", "customers"),
    "days_between_events": oracle.event_spans(),
    "sim_features": oracle.sim_features(),
    "sim_scaled": oracle.sim_scaled(),
    "sim_popular": oracle.sim_popular(10),
    "sim_target": oracle.sim_target(),
    "sim_top_n": oracle.sim_top_n(SIM_TOP_N),
    "sim_unknown_id": oracle.sim_unknown_id(UNKNOWN_ID),
    "sim_embeddings": oracle.sim_embeddings(SIM_TOP_N),
}
