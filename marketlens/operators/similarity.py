"""Product similarity: feature table, min-max scaling, cosine top-N.

Plan shape (no cross join, nothing collected to the driver):

* ``product_features`` — the orders are read once and aggregated to (product,
  order); that small table is written to the shared folder and gives the price
  means, the order counts and the pairs that join the reviews (two plain
  shuffles, which adaptive execution can split). Missing values become 0.
* ``scale_features`` — the eleven global minima / maxima are one aggregate,
  attached to every row as a single scalar subquery (one row, computed once);
  a constant feature (range 0) scales to 0. The norm of the scaled vector is
  stored with it.
* ``similar_products`` — the target's vector and norm are another scalar
  subquery; the cosine is arithmetic on plain columns (code-generated), and the
  top N is a ``TakeOrderedAndProject`` (per-task top N, then a merge of N rows
  per task) — never a full sort or an all-pairs product. Rows are ranked on the
  full score; only the returned value is rounded.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.expr import MONEY_SCALE, cosine_of, dot, label_or_unknown, money, norm
from marketlens.session import materialize, session_key
from marketlens.sources.warehouse import Tables

# The eleven features, in vector order.
FEATURES = [
    "weight_g", "length_cm", "height_cm", "width_cm",
    "avg_price", "order_count", "avg_review", "review_count",
    "product_name_length", "product_description_length", "product_photos_qty",
]

# Digits of the returned similarity (never of the ranking).
SIM_DIGITS = 6


def product_features(t: Tables) -> DataFrame:
    """One row per product: id, English category and the eleven features."""
    per_order = materialize(
        t.orders.where(F.col("product_id").isNotNull()).groupBy("product_id", "order_id").agg(
            F.sum(money("price")).alias("_price"), F.count("price").alias("_n")), "product-orders")
    units = (F.sum("_price") * 10 ** MONEY_SCALE).cast("double")
    n = F.sum("_n")
    stats = per_order.groupBy("product_id").agg(
        F.when(n > 0, units / (n * F.lit(10 ** MONEY_SCALE)).cast("double")).alias("avg_price"),
        F.count("order_id").alias("order_count"))
    reviews = t.reviews.select(
        "review_id", "order_id",
        F.expr("try_cast(review_score AS double)").alias("review_score"))
    per_product_reviews = (per_order.select("order_id", "product_id").join(reviews, "order_id")
                           .groupBy("product_id")
                           .agg(F.avg("review_score").alias("avg_review"),
                                F.countDistinct("review_id").alias("review_count")))
    p = t.products_flat.select("product_id", "category_english", "weight_g", "length_cm",
                               "height_cm", "width_cm", "product_name_length",
                               "product_description_length", "product_photos_qty")
    joined = p.join(stats, "product_id", "left").join(per_product_reviews, "product_id", "left")
    return joined.select("product_id", "category_english",
                         *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES])


_CACHE: dict[tuple[str, str, str], DataFrame] = {}


def _once(t: Tables, name: str, make) -> DataFrame:
    """``make()`` written once for a converted snapshot.

    A snapshot is known by the names of its data files: every conversion writes
    files with new names, so a folder converted again is a new snapshot. Lazily
    derived tables (no folder) are computed on every call.
    """
    if t.root is None:
        return materialize(make(), name)
    files = sorted(f for df in (t.orders, t.products, t.reviews) for f in df.inputFiles())
    key = (session_key(t.orders.sparkSession), name, hashlib.sha256("\n".join(files).encode()).hexdigest())
    if key not in _CACHE:
        _CACHE[key] = materialize(make(), name)
    return _CACHE[key]


def feature_table(t: Tables) -> DataFrame:
    """The feature table of a converted snapshot, written once."""
    return _once(t, "features", lambda: product_features(t))


def scale_features(features: DataFrame) -> DataFrame:
    """Min-max scale each feature to [0, 1]; a zero range is treated as 1."""
    bounds = features.agg(F.struct(
        *[F.min(f).alias(f"{f}_min") for f in FEATURES],
        *[F.max(f).alias(f"{f}_max") for f in FEATURES]).alias("b")).scalar()
    with_b = features.select("*", bounds.alias("_b"))
    scaled = []
    for f in FEATURES:
        lo, hi = F.col(f"_b.{f}_min"), F.col(f"_b.{f}_max")
        rng = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)
        scaled.append(((F.col(f) - lo) / rng).alias(f"s_{f}"))
    out = with_b.select("product_id", "category_english", "avg_price", "avg_review",
                        "order_count", "review_count", *scaled)
    return out.withColumn("norm", F.sqrt(_dot_columns(lambda f: F.col(f"s_{f}"), lambda f: F.col(f"s_{f}"))))


def _dot_columns(a, b):
    """Sum of the features' products, left to right from 0.0."""
    return reduce(lambda s, f: s + a(f) * b(f), FEATURES, F.lit(0.0))


def scaled_table(t: Tables) -> DataFrame:
    """Scaled features and norms of a converted snapshot, written once (the
    bounds subquery then runs once per snapshot, not once per lookup)."""
    return _once(t, "scaled", lambda: scale_features(feature_table(t)))


def popular_products(features: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the most orders (ties: smaller product id first)."""
    return (features.select("product_id", label_or_unknown("category_english").alias("category"),
                            F.col("order_count").cast("long").alias("order_count"))
            .orderBy(F.col("order_count").desc(), F.col("product_id").asc())
            .limit(n))


def most_popular_id(features: DataFrame):
    """Scalar subquery: id of the most ordered product."""
    return (features.orderBy(F.col("order_count").desc(), F.col("product_id").asc())
            .limit(1).select("product_id").scalar())


def _value(product_id):
    return F.lit(product_id) if isinstance(product_id, (int, str)) else product_id


def target_product(scaled: DataFrame, product_id) -> DataFrame:
    """The asked product itself: category, mean price, mean score, reviews."""
    return scaled.where(F.col("product_id") == _value(product_id)).select(
        "product_id", label_or_unknown("category_english").alias("category"),
        "avg_price", "avg_review", "review_count")


def similar_products(scaled: DataFrame, product_id, top_n: int = 5) -> DataFrame:
    """The ``top_n`` products most similar (cosine) to ``product_id``.

    ``product_id`` is a value or a Column (e.g. a scalar subquery). Empty when
    the id does not exist. Ranked on the full similarity (equal: smaller id
    first), which is rounded for output only.
    """
    names = ["product_id", *[f"s_{f}" for f in FEATURES], "norm"]
    target = (scaled.where(F.col("product_id") == _value(product_id))
              .agg(F.min(F.struct(*names)).alias("t")).scalar())
    v = scaled.select("*", target.alias("_t"))
    nearness = cosine_of(_dot_columns(lambda f: F.col(f"s_{f}"), lambda f: F.col(f"_t.s_{f}")), "norm", "_t.norm")
    return (v.where(F.col("_t").isNotNull() & (F.col("product_id") != F.col("_t.product_id")))
            .select("product_id", label_or_unknown("category_english").alias("category"),
                    "avg_price", "avg_review", nearness.alias("_nearness"))
            .orderBy(F.col("_nearness").desc_nulls_last(), F.col("product_id").asc())
            .limit(top_n)
            .select("product_id", "category", "avg_price", "avg_review",
                    F.round("_nearness", SIM_DIGITS).alias("similarity")))


def find_similar(scaled: DataFrame, product_id, top_n: int = 5, n_samples: int = 5) -> DataFrame:
    """Similar products, or — when the id is unknown — sample ids to pick from.

    Columns: kind ('similar' | 'sample'), product_id, category, avg_price,
    avg_review, similarity (NULL for samples).
    """
    pid = _value(product_id)
    similar = similar_products(scaled, pid, top_n).select(F.lit("similar").alias("kind"), "*")
    known = scaled.where(F.col("product_id") == pid).exists()
    samples = (scaled.where(~known).orderBy("product_id").limit(n_samples)
               .select(F.lit("sample").alias("kind"), "product_id",
                       label_or_unknown("category_english").alias("category"),
                       "avg_price", "avg_review", F.lit(None).cast("double").alias("similarity")))
    return similar.unionByName(samples)


def similar_embeddings(embeddings: DataFrame, top_n: int = 10, vec_id=None) -> DataFrame:
    """Cosine top-N over stored embedding vectors (target: ``vec_id`` or the
    smallest id), excluding the target itself."""
    e = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    e = e.select("*", norm("v").alias("_n"))
    pick = e if vec_id is None else e.where(F.col("vec_id") == vec_id)
    # Target row (smallest id by default) with its norm as one top-1 scalar subquery.
    target = (pick.orderBy(F.col("vec_id").asc()).limit(1)
              .select(F.struct("vec_id", "v", "_n").alias("t")).scalar())
    e = e.select("*", target.alias("_t")).where(F.col("vec_id") != F.col("_t.vec_id"))
    return (e.select("vec_id", "label", cosine_of(dot("v", "_t.v"), "_n", "_t._n").alias("_nearness"))
            .orderBy(F.col("_nearness").desc_nulls_last(), F.col("vec_id").asc())
            .limit(top_n)
            .select("vec_id", "label", F.round("_nearness", SIM_DIGITS).alias("similarity")))
