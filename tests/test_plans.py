"""Plan shape: pruning, pushdown, and no all-pairs operators anywhere."""

from __future__ import annotations

import re

import pytest

from marketlens.plans import reports as R
from marketlens.plans.measure import plan_text


def _scan_lines(plan: str, key: str) -> list[str]:
    return [ln for ln in plan.splitlines() if ln.strip().startswith(key)]


def test_q1_year_filter_prunes_partitions(tables):
    plan = plan_text(R.revenue_trend(tables, years=(1996, 1997)))
    pf = _scan_lines(plan, "PartitionFilters:")
    assert any("year" in ln and "1996" in ln for ln in pf), pf


def test_q5_reads_only_needed_columns(tables):
    plan = plan_text(R.geo_revenue(tables))
    schemas = _scan_lines(plan, "ReadSchema:")
    orders_schema = [s for s in schemas if "order_purchase_timestamp" in s][0]
    cols = re.findall(r"(\w+):", orders_schema.split("struct<", 1)[1])
    assert set(cols) == {"order_id", "customer_id", "order_purchase_timestamp", "price"}


def test_q2n_nested_pruning_and_pushdown(tables):
    plan = plan_text(R.top_categories_nested(tables))
    schemas = _scan_lines(plan, "ReadSchema:")
    prod = [s for s in schemas if "dimensions" in s][0]
    assert "length_cm" not in prod and "weight_g" in prod and "portuguese" not in prod
    pushed = " ".join(_scan_lines(plan, "PushedFilters:"))
    assert "dimensions.weight_g" in pushed


def test_q4_score_filter_prunes_review_partitions(tables):
    plan = plan_text(R.low_reviews(tables))
    assert any("review_score" in ln for ln in _scan_lines(plan, "PartitionFilters:"))


def test_top_k_is_take_ordered(tables):
    assert "TakeOrderedAndProject" in plan_text(R.top_categories(tables))


def _all_query_names():
    from marketlens.registry import QUERIES

    return sorted(QUERIES)


@pytest.mark.parametrize("name", _all_query_names())
def test_no_cartesian_or_nested_loop(spark, name):
    from marketlens.registry import QUERIES

    plan = plan_text(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "collect_list" not in plan and "collect_set" not in plan
