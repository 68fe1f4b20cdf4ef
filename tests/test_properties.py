"""
similarity is in [0, 1] for non-negative vectors and 1 for a vector with
itself."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.functions.expr import cosine
from marketlens.plans import reports as R

YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


@settings(max_examples=6, deadline=None)
@given(st.sets(st.sampled_from(YEARS), min_size=1, max_size=4))
def test_q1_month_totals_add_up_to_the_years(tables, years):
    rows = R.revenue_trend(tables, years=tuple(sorted(years))).collect()
    by_month = sum(Decimal(str(r.total_revenue)) for r in rows if r.total_revenue is not None)
    direct = (tables.orders.where(F.col("year").isin(sorted(years)))
              .agg(F.sum(F.col("price").cast("decimal(18,2)"))).first()[0] or Decimal(0))
    assert by_month == direct
    assert {r.year for r in rows} <= set(years)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=3, max_size=3),
                min_size=2, max_size=6))
def test_cosine_bounds_for_non_negative_vectors(spark, vectors):
    df = spark.createDataFrame([(v, w) for v in vectors for w in vectors], "a array<double>, b array<double>")
    out = df.select(cosine("a", "b").alias("c"), cosine("a", "a").alias("self"),
                    F.aggregate("a", F.lit(0.0), lambda s, x: s + x).alias("norm")).collect()
    for r in out:
        assert -1e-12 <= r.c <= 1 + 1e-12
        if r.norm > 1e-150:
            assert abs(r.self - 1.0) < 1e-9
