"""Similarity on a four-product fixture: two identical, one all-zero, one
feature constant across all products (FIXTURES.md §3)."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from marketlens.operators import similarity as S


@pytest.fixture(scope="module")
def features(spark):
    rows = [
        ("a", "toys", [1.0, 2.0, 3.0, 4.0, 10.0, 2.0, 4.0, 1.0, 30.0, 300.0, 2.0]),
        ("b", "toys", [1.0, 2.0, 3.0, 4.0, 10.0, 2.0, 4.0, 1.0, 30.0, 300.0, 2.0]),
        ("c", None, [0.0] * 10 + [2.0]),
        ("d", "", [5.0, 1.0, 0.0, 2.0, 50.0, 9.0, 1.0, 5.0, 60.0, 100.0, 2.0]),
    ]
    data = [(pid, cat, *vals) for pid, cat, vals in rows]
    cols = "product_id string, category_english string, " + ", ".join(f"{f} double" for f in S.FEATURES)
    return spark.createDataFrame(data, cols)


def test_constant_feature_scales_to_zero_and_range_is_unit(features):
    scaled = {r.product_id: r for r in S.scale_features(features).collect()}
    assert all(r.s_product_photos_qty == 0.0 for r in scaled.values())
    assert scaled["c"].s_weight_g == 0.0 and scaled["d"].s_weight_g == 1.0
    for r in scaled.values():
        assert all(0.0 <= r[f"s_{f}"] <= 1.0 for f in S.FEATURES)


def test_identical_product_is_most_similar_and_zero_vector_scores_zero(features):
    out = S.similar_products(S.scale_features(features), "a", top_n=5).collect()
    assert [r.product_id for r in out][0] == "b" and out[0].similarity == 1.0
    by_id = {r.product_id: r for r in out}
    assert by_id["c"].similarity == 0.0 and "a" not in by_id
    assert by_id["c"].category == "unknown" and by_id["d"].category == "unknown"


def test_similarity_is_symmetric(features):
    sc = S.scale_features(features)
    ab = {r.product_id: r.similarity for r in S.similar_products(sc, "a", 5).collect()}
    da = {r.product_id: r.similarity for r in S.similar_products(sc, "d", 5).collect()}
    assert ab["d"] == da["a"]


def test_unknown_id_gives_samples_known_id_gives_no_samples(features):
    sc = S.scale_features(features)
    unknown = S.find_similar(sc, "zzz", top_n=5, n_samples=2).collect()
    assert [(r.kind, r.product_id) for r in unknown] == [("sample", "a"), ("sample", "b")]
    known = S.find_similar(sc, "a", top_n=2).collect()
    assert {r.kind for r in known} == {"similar"} and len(known) == 2


def test_popular_ties_break_on_id(features):
    out = S.popular_products(features, 3).collect()
    assert [r.product_id for r in out] == ["d", "a", "b"]


def test_top_n_plan_has_no_cartesian_product(features):
    from marketlens.plans.measure import plan_text

    plan = plan_text(S.similar_products(S.scale_features(features), "a", 5))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in plan


def test_embeddings_self_excluded(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 1, [2.0, 0.0]), (3, 1, [0.0, 1.0])],
                               "vec_id long, label int, embedding array<float>")
    out = S.similar_embeddings(df, top_n=5).collect()
    assert [(r.vec_id, r.similarity) for r in out] == [(2, 1.0), (3, 0.0)]


def _scaled(spark, rows):
    """Scaled table from (id, two features); the other features are constant."""
    feats = [dict({f: 0.0 for f in S.FEATURES}, weight_g=a, length_cm=b) for _, a, b in rows]
    df = spark.createDataFrame([(r[0], "c" * 40, *f.values()) for r, f in zip(rows, feats)],
                               "product_id string, category_english string, " + ", ".join(f"{f} double" for f in S.FEATURES))
    return df.select("product_id", "category_english", "avg_price", "avg_review", "order_count", "review_count",
                     *[F.col(f).alias(f"s_{f}") for f in S.FEATURES],
                     F.sqrt(F.col("weight_g") ** 2 + F.col("length_cm") ** 2).alias("norm"))


def test_neighbours_are_ranked_on_the_full_score(spark):
    """Both neighbours round to 1.000000; the nearer one comes first, with its whole label."""
    scaled = _scaled(spark, [("t", 1.0, 0.0), ("a", 1.0, 0.0009), ("b", 1.0, 0.0003)])
    got = S.similar_products(scaled, "t", 1).collect()
    assert [(r.product_id, r.similarity, r.category) for r in got] == [("b", 1.0, "c" * 40)]
    target = S.target_product(scaled, "t").first()
    assert target.product_id == "t" and target.review_count == 0.0


def test_cosine_projection_is_generated_code(spark, tables):
    plan = S.similar_products(S.scaled_table(tables), 1, 3)
    text = plan._jdf.queryExecution().toString()
    assert "zip_with" not in text and "aggregate(" not in text


def test_features_follow_a_new_conversion(spark, tmp_path):
    """The same folder converted again from other inputs is another snapshot."""
    from marketlens.sources.testdata import raw_inputs
    from marketlens.sources.warehouse import build_warehouse, open_tables

    root = str(tmp_path / "lake")
    raw = raw_inputs(spark, "/root/testdata/sf0.001")
    build_warehouse(raw, root)
    first = S.feature_table(open_tables(spark, root)).count()
    raw.products = raw.products.where("product_id <= 50")
    build_warehouse(raw, root)
    assert first > 51 and S.feature_table(open_tables(spark, root)).count() == 51  # ids begin at 0
