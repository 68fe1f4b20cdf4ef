"""DuckDB twins of the registered queries (the driver's correctness oracle).

The driver pre-registers its tables (``orders``, ``lineitem``, ``part`` …) as
views. Each twin re-states, as CTEs, the adapter (``sources.testdata``) and
the conversion jobs (``operators.etl``), then the report on top. Money and
ratios use the same exact arithmetic as the Spark side: decimal sums and
half-away-from-zero integer rounding.
"""

from __future__ import annotations


def rr(num: str, den: str, digits: int, num_scale: int = 0) -> str:
    """SQL twin of ``functions.expr.round_ratio``."""
    n, d = f"({num})", f"({den})"
    big_n = f"CAST({n} * {10 ** num_scale} AS HUGEINT)"
    big_d = f"(CAST({d} AS HUGEINT) * {10 ** num_scale})"
    q = f"((2 * abs({big_n}) * {10 ** digits} + {big_d}) // (2 * {big_d}))"
    sign = f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END)"
    return (f"(CASE WHEN {n} IS NULL OR {d} IS NULL OR {d} = 0 THEN NULL "
            f"ELSE CAST({sign} * {q} AS DOUBLE) / CAST({10 ** digits} AS DOUBLE) END)")


MONEY = "DECIMAL(28,8)"
MONEY_SCALE = 8
MEASURE = "DECIMAL(24,6)"


def msum(col: str) -> str:
    """Exact sum of a money column."""
    return f"sum(CAST({col} AS {MONEY}))"


def mtotal(col: str) -> str:
    """That sum, rounded once to cents, as double."""
    return f"CAST(round({msum(col)}, 2) AS DOUBLE)"


# ---- adapter + conversion, as CTEs -----------------------------------------
CTES = {
    "src_ship": """
        SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_orderkey""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing'
                    WHEN 'P' THEN 'shipped' ELSE o_orderstatus END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate AS order_approved_at,
               first_ship AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN last_ship END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
        FROM orders LEFT JOIN src_ship ON o_orderkey = l_orderkey""",
    "raw_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               l_extendedprice * l_tax AS freight_value
        FROM lineitem""",
    "raw_payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
               l_returnflag AS payment_type, CAST(l_quantity AS INTEGER) AS payment_installments,
               l_extendedprice AS payment_value
        FROM lineitem""",
    "pay_agg": f"""
        SELECT order_id,
               arg_min(payment_type, row(payment_sequential, payment_type, payment_installments,
                                         payment_value))
                 FILTER (WHERE payment_type IS NOT NULL) AS payment_type,
               max(payment_installments) AS payment_installments,
               CAST(coalesce({msum('payment_value')}, 0) AS DOUBLE) AS payment_value
        FROM raw_payments WHERE order_id IS NOT NULL GROUP BY order_id""",
    "m_orders": """
        SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
               o.order_approved_at, o.order_delivered_carrier_date,
               o.order_delivered_customer_date, o.order_estimated_delivery_date,
               i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
               i.price, i.freight_value, p.payment_type, p.payment_installments, p.payment_value,
               CAST(year(o.order_purchase_timestamp) AS INTEGER) AS year,
               CAST(month(o.order_purchase_timestamp) AS INTEGER) AS month
        FROM raw_orders o
        LEFT JOIN raw_items i ON o.order_id = i.order_id
        LEFT JOIN pay_agg p ON o.order_id = p.order_id""",
    "raw_products": """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
               CAST(length(concat_ws(' ', p_name, p_brand)) AS DOUBLE) AS product_description_lenght,
               CAST(1.0 AS DOUBLE) AS product_photos_qty,
               CAST(p_size AS DOUBLE) * 100.0 AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(length(p_name) AS DOUBLE) AS product_height_cm,
               CAST(length(p_type) AS DOUBLE) AS product_width_cm
        FROM part""",
    "raw_categories": """
        SELECT DISTINCT p_type AS product_category_name,
               lower(p_type) AS product_category_name_english
        FROM part""",
    "m_products_flat": """
        SELECT p.product_id,
               p.product_category_name AS category_portuguese,
               c.product_category_name_english AS category_english,
               CASE WHEN isnan(product_weight_g) THEN NULL ELSE product_weight_g END AS weight_g,
               CASE WHEN isnan(product_length_cm) THEN NULL ELSE product_length_cm END AS length_cm,
               CASE WHEN isnan(product_height_cm) THEN NULL ELSE product_height_cm END AS height_cm,
               CASE WHEN isnan(product_width_cm) THEN NULL ELSE product_width_cm END AS width_cm,
               CASE WHEN isnan(product_name_lenght) THEN NULL ELSE product_name_lenght END
                 AS product_name_length,
               CASE WHEN isnan(product_description_lenght) THEN NULL
                    ELSE product_description_lenght END AS product_description_length,
               CASE WHEN isnan(product_photos_qty) THEN NULL ELSE product_photos_qty END
                 AS product_photos_qty
        FROM raw_products p
        LEFT JOIN raw_categories c ON p.product_category_name = c.product_category_name""",
    "raw_geo": """
        SELECT c_nationkey AS zip, CAST(floor(c_acctbal / 100) AS DOUBLE) AS lat,
               CAST(-floor(c_acctbal / 10) AS DOUBLE) AS lng
        FROM customer""",
    "geo_agg": """
        SELECT CAST(zip AS VARCHAR) AS geolocation_zip_code_prefix,
               avg(lat) AS geolocation_lat, avg(lng) AS geolocation_lng
        FROM raw_geo WHERE zip IS NOT NULL GROUP BY CAST(zip AS VARCHAR)""",
    "m_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
               CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state,
               g.geolocation_lat, g.geolocation_lng
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN geo_agg g ON CAST(c_nationkey AS VARCHAR) = g.geolocation_zip_code_prefix""",
    "m_sellers": """
        SELECT s_suppkey AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
               s_name AS seller_city, n_name AS seller_state,
               g.geolocation_lat, g.geolocation_lng
        FROM supplier
        LEFT JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN geo_agg g ON CAST(s_nationkey AS VARCHAR) = g.geolocation_zip_code_prefix""",
    "m_reviews": """
        SELECT d.doc_id AS review_id, d.doc_id AS order_id,
               '' AS review_comment_title,
               coalesce(d.text, '') AS review_comment_message,
               CAST(NULL AS TIMESTAMP) AS review_creation_date,
               CAST(NULL AS TIMESTAMP) AS review_answer_timestamp,
               CAST(1 + 2 * l.quality + (1 - l.toxic) AS INTEGER) AS review_score
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
}


def with_model(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every adapter / conversion CTE (plus ``extra``)."""
    items = {**CTES, **(extra or {})}
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in items.items())
    return f"WITH {ctes}\n{body}"


# ---- reports ------------------------------------------------------------------
def q1(years=(1996, 1997)) -> str:
    ys = ", ".join(str(y) for y in years)
    return with_model(f"""
SELECT year, month,
       count(DISTINCT order_id) AS total_orders,
       {mtotal('price')} AS total_revenue,
       {mtotal('freight_value')} AS total_freight,
       {rr(msum('price'), 'count(price)', 2, MONEY_SCALE)} AS avg_order_value
FROM m_orders WHERE year IN ({ys})
GROUP BY year, month ORDER BY year, month""")


def _category_revenue(where: str, limit: int) -> str:
    return with_model(f"""
SELECT p.category_english AS category,
       count(DISTINCT o.order_id) AS order_count,
       {mtotal('o.price')} AS total_revenue,
       {rr(f'sum(CAST(p.weight_g AS {MEASURE}))', 'count(p.weight_g)', 0, 6)} AS avg_weight_g
FROM m_orders o JOIN m_products_flat p ON o.product_id = p.product_id
WHERE {where}
GROUP BY p.category_english
ORDER BY total_revenue DESC NULLS LAST, category ASC NULLS LAST
LIMIT {limit}""")


def q2(max_weight=5000, limit=15) -> str:
    return _category_revenue(f"p.weight_g < {max_weight}", limit)


def q3() -> str:
    return with_model(f"""
SELECT date_trunc('month', since) AS cohort_month, count(*) AS cohort_size,
       count(*) FILTER (WHERE orders_made >= 2) AS repeat_customers,
       {rr('count(*) FILTER (WHERE orders_made >= 2) * 100', 'count(*)', 1)} AS repeat_rate_pct
FROM (SELECT min(order_purchase_timestamp) AS since, count(DISTINCT order_id) AS orders_made
      FROM m_orders WHERE order_status = 'delivered' GROUP BY customer_id)
GROUP BY 1 ORDER BY 1""")


def q4(max_score=2, limit=20) -> str:
    return with_model(f"""
SELECT p.category_english AS category, r.review_score,
       count(*) AS review_count,
       {rr('sum(length(r.review_comment_message))', 'count(r.review_comment_message)', 0)}
         AS avg_comment_length
FROM m_reviews r
JOIN m_orders o ON r.order_id = o.order_id
JOIN m_products_flat p ON o.product_id = p.product_id
WHERE r.review_score <= {max_score}
GROUP BY p.category_english, r.review_score
ORDER BY review_count DESC, category ASC NULLS LAST, review_score ASC
LIMIT {limit}""")


def q5() -> str:
    return with_model(f"""
SELECT c.customer_state AS state,
       date_trunc('quarter', o.order_purchase_timestamp) AS quarter,
       count(DISTINCT o.order_id) AS order_count,
       {mtotal('o.price')} AS total_revenue,
       {rr(msum('o.price'), 'count(DISTINCT o.order_id)', 2, MONEY_SCALE)} AS avg_order_value
FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id
GROUP BY c.customer_state, date_trunc('quarter', o.order_purchase_timestamp)
ORDER BY state NULLS LAST, quarter NULLS LAST""")


def _days(start: str, end: str) -> str:
    return f"date_sub('day', {start}, {end})"


def _delivery_review(having: str, order_limit: str, with_delay: bool, rank: str = "avg_review_score") -> str:
    span = _days("o.order_purchase_timestamp", "o.order_delivered_customer_date")
    late = _days("o.order_estimated_delivery_date", "o.order_delivered_customer_date")
    delay = f"{rr(f'sum({late})', f'count({late})', 1)} AS avg_delay_days," if with_delay else ""
    return with_model(f"""
SELECT c.customer_state AS state,
       {rr('sum(r.review_score)', 'count(r.review_score)', 2)} AS avg_review_score,
       {rr(f'sum({span})', f'count({span})', 1)} AS avg_delivery_days,
       {delay}
       count(DISTINCT o.order_id) AS total_orders
FROM m_orders o
JOIN m_reviews r ON o.order_id = r.order_id
JOIN m_customers c ON o.customer_id = c.customer_id
WHERE o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
GROUP BY c.customer_state
{having}
ORDER BY {rank} ASC NULLS LAST, state ASC NULLS LAST
{order_limit}""")


def q6(min_orders=3) -> str:
    return _delivery_review(f"HAVING count(DISTINCT o.order_id) > {min_orders}", "", True)


def q7(limit=5) -> str:
    return with_model(f"""
SELECT c.customer_state, count(*) AS order_count
FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id
GROUP BY c.customer_state
ORDER BY order_count DESC, customer_state ASC NULLS LAST
LIMIT {limit}""")


def q8(year=1997) -> str:
    return with_model(f"""
SELECT year, month, count(DISTINCT order_id) AS order_count,
       {mtotal('price')} AS total_revenue
FROM m_orders WHERE year = {year}
GROUP BY year, month ORDER BY year, month""")


def _top_cat_revenue(where: str, k: int, extra_join: str = "") -> str:
    return with_model(f"""
SELECT p.category_english AS category, {mtotal('o.price')} AS total_revenue
FROM m_orders o JOIN m_products_flat p ON o.product_id = p.product_id
{extra_join}
WHERE {where}
GROUP BY p.category_english
ORDER BY total_revenue DESC NULLS LAST, category ASC NULLS LAST
LIMIT {k}""")


def n1(k=5) -> str:
    return _top_cat_revenue("TRUE", k)


def n2(years=(1996, 1997)) -> str:
    ys = ", ".join(str(y) for y in years)
    unit = lambda c: f"CAST({c} * {10 ** MONEY_SCALE} AS DECIMAL(38,0))"
    return with_model(f"""
SELECT a.year, CAST(round(a.rev, 2) AS DOUBLE) AS total_revenue, CAST(round(b.rev, 2) AS DOUBLE) AS prev_revenue,
       {rr(f"({unit('a.rev')} - {unit('b.rev')}) * 100", unit('b.rev'), 2)} AS growth_pct
FROM per_year a LEFT JOIN per_year b ON a.year = b.year + 1
ORDER BY a.year""", {"per_year": f"""
        SELECT year, {msum('price')} AS rev FROM m_orders WHERE year IN ({ys}) GROUP BY year"""})


def n3() -> str:
    return with_model(f"""
SELECT payment_type, order_count,
       {rr('order_count * 100', 'sum(order_count) OVER ()', 2)} AS share_pct
FROM per_type ORDER BY order_count DESC, payment_type ASC NULLS LAST""", {"per_type": """
        SELECT payment_type, count(DISTINCT order_id) AS order_count
        FROM m_orders GROUP BY payment_type"""})


def n4(k=5) -> str:
    mean = f"CAST(sum(r.review_score) AS HUGEINT) * {10 ** 18} // nullif(count(r.review_score), 0)"
    return _delivery_review("", f"LIMIT {k}", False, mean)


def n5(k=5, score=1) -> str:
    return with_model(f"""
SELECT p.category_english AS category, count(DISTINCT r.review_id) AS review_count
FROM m_reviews r
JOIN m_orders o ON r.order_id = o.order_id
JOIN m_products_flat p ON o.product_id = p.product_id
WHERE r.review_score = {score}
GROUP BY p.category_english
ORDER BY review_count DESC, category ASC NULLS LAST
LIMIT {k}""")


QUARTER_MONTHS = {1: (1, 2, 3), 2: (4, 5, 6), 3: (7, 8, 9), 4: (10, 11, 12)}


def n6(year=1997, quarter=4, city="HOUSEHOLD", k=5) -> str:
    months = ", ".join(str(m) for m in QUARTER_MONTHS[quarter])
    where = f"o.year = {year} AND o.month IN ({months})"
    if city is not None:
        where += (f" AND o.customer_id IN (SELECT customer_id FROM m_customers "
                  f"WHERE customer_city = '{city}')")
    return _top_cat_revenue(where, k)


def n7(year=1997, k=5) -> str:
    return _top_cat_revenue(f"o.year = {year}", k)


def n8(year=1997, quarter=4, k=5) -> str:
    months = ", ".join(str(m) for m in QUARTER_MONTHS[quarter])
    return with_model(f"""
SELECT c.customer_state AS state, count(DISTINCT o.order_id) AS order_count
FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id
WHERE o.year = {year} AND o.month IN ({months})
GROUP BY c.customer_state
ORDER BY order_count DESC, state ASC NULLS LAST
LIMIT {k}""")


# ---- converted tables, sources and catalog round trips -------------------------
def table(name: str, where: str = "TRUE", cols: str = "*") -> str:
    return with_model(f"SELECT {cols} FROM {name} WHERE {where}")


def appended(name: str, runs: int) -> str:
    return with_model(f"SELECT m.* FROM {name} m, range({runs})")


def pruned_rows(name: str, where: str, parts: str) -> str:
    return with_model(f"""
SELECT count(DISTINCT ({parts})) FILTER (WHERE {where}) AS partitions_read,
       count(DISTINCT ({parts})) AS partitions_total,
       count(*) FILTER (WHERE {where}) AS rows_read, count(*) AS rows_total
FROM {name}""".replace("(DISTINCT (", "(DISTINCT row("))


def table_checks(min_partitions: dict[str, int]) -> str:
    # fixed values: table, raw table, rows that lack a required value, partition columns
    shape = [("orders", "m_orders", "raw_items", "order_id IS NULL OR customer_id IS NULL OR order_status IS NULL "
              "OR (order_item_id IS NOT NULL AND (price IS NULL OR freight_value IS NULL))", "year, month"),
             ("products", "m_products_flat", "raw_products", "product_id IS NULL", "0"),
             ("customers", "m_customers", "customer", "customer_id IS NULL OR customer_state IS NULL", "0"),
             ("reviews", "m_reviews", "m_reviews", "review_id IS NULL OR order_id IS NULL OR review_score IS NULL",
              "review_score"),
             ("sellers", "m_sellers", "supplier", "seller_id IS NULL", "0")]
    rows = []
    for name, view, raw, lack, parts in shape:
        need = f"(SELECT count(*) FROM {raw})"
        rows.append(f"""SELECT '{name}' AS table_name, count(*) AS row_count,
  {need} AS min_rows, count(*) FILTER (WHERE {lack}) AS incomplete,
  count(DISTINCT row({parts})) AS partitions,
  count(*) > 0 AND count(*) >= {need} AND count(*) FILTER (WHERE {lack}) = 0
    AND count(DISTINCT row({parts})) >= {min_partitions.get(name, 1)} AS ok FROM {view}""")
    return with_model(" UNION ALL ".join(rows))


def split_good_bad(every: int) -> str:
    """Payments written as text with every ``every``-th order's instalments spoilt."""
    bad = f"order_id % {every} = 0"
    return with_model(f"""
SELECT 'good' AS kind, count(*) AS row_count, CAST(sum(order_id) AS BIGINT) AS id_sum FROM raw_payments WHERE NOT ({bad})
UNION ALL SELECT 'bad', count(*), CAST(sum(order_id) AS BIGINT) FROM raw_payments WHERE {bad}""")


def format_reads(year: int, month: int) -> str:
    """One row per format and read; the rows' digest is the same for every format."""
    def one(read, where, cols):
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
        return f"""SELECT '{read}' AS read, count(*) AS row_count,
  CAST(coalesce(sum(CAST(concat('0x', substr(md5(concat_ws('|', {text})), 1, 12)) AS BIGINT)), 0) AS VARCHAR) AS digest
FROM m_orders WHERE {where}"""
    month_of = f"CAST(order_purchase_timestamp AS VARCHAR) LIKE '{year}-{month:02d}%'"
    reads = [one("full", "TRUE", FORMAT_COLUMNS), one("projected", "TRUE", ["order_id", "order_status"]),
             one("filtered", month_of, FORMAT_COLUMNS)]
    return with_model("SELECT f.format, r.* FROM (VALUES ('csv'), ('json'), ('parquet')) f(format), ("
                      + " UNION ALL ".join(reads) + ") r")


# The columns whose text both engines write alike.
FORMAT_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
                  "order_item_id", "product_id", "seller_id", "CAST(price AS DECIMAL(28,8))", "payment_type",
                  "payment_installments", "CAST(payment_value AS DECIMAL(28,8))", "year", "month"]


def distinct_by(key: str, groups: str, where: str, name: str) -> str:
    return with_model(f"""SELECT {groups}, count(DISTINCT o.{key}) AS {name}
FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id WHERE {where} GROUP BY {groups}""")


def payments_per_order() -> str:
    return with_model("SELECT * FROM pay_agg")


def overview() -> str:
    return with_model("""
SELECT * FROM per_table
UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT), '' FROM per_table
ORDER BY table_name""", {"per_table": """
        SELECT 'orders' AS table_name, count(*) AS row_count, 'year, month' AS partitioned_by
          FROM m_orders
        UNION ALL SELECT 'products', count(*), '--' FROM m_products_flat
        UNION ALL SELECT 'customers', count(*), '--' FROM m_customers
        UNION ALL SELECT 'reviews', count(*), 'review_score' FROM m_reviews
        UNION ALL SELECT 'sellers', count(*), '--' FROM m_sellers"""})


def event_spans() -> str:
    return """
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts,
       date_sub('day', min(ts), max(ts)) AS span_days,
       date_sub('day', max(ts), min(ts)) AS span_days_reversed
FROM events GROUP BY user_id"""


# ---- product similarity ---------------------------------------------------------
SIM_FEATURES = [
    "weight_g", "length_cm", "height_cm", "width_cm",
    "avg_price", "order_count", "avg_review", "review_count",
    "product_name_length", "product_description_length", "product_photos_qty",
]


def _sim_ctes() -> dict[str, str]:
    feats = ",\n".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" for f in SIM_FEATURES)
    bounds = ",\n".join([f"min({f}) AS {f}_min, max({f}) AS {f}_max" for f in SIM_FEATURES])
    scaled = ",\n".join(
        f"({f} - {f}_min) / (CASE WHEN {f}_max - {f}_min = 0 THEN CAST(1 AS DOUBLE) "
        f"ELSE {f}_max - {f}_min END) AS s_{f}" for f in SIM_FEATURES)
    squares = " + ".join(["CAST(0 AS DOUBLE)"] + [f"s_{f} * s_{f}" for f in SIM_FEATURES])
    return {
        "sim_stats": f"""
            SELECT product_id,
                   CASE WHEN count(price) > 0 THEN
                     CAST({msum('price')} * {10 ** MONEY_SCALE} AS DOUBLE)
                       / CAST(count(price) * {10 ** MONEY_SCALE} AS DOUBLE)
                   END AS avg_price,
                   count(DISTINCT order_id) AS order_count
            FROM m_orders WHERE product_id IS NOT NULL GROUP BY product_id""",
        "sim_reviews": """
            SELECT op.product_id, avg(TRY_CAST(r.review_score AS DOUBLE)) AS avg_review,
                   count(DISTINCT r.review_id) AS review_count
            FROM m_reviews r
            JOIN (SELECT DISTINCT order_id, product_id FROM m_orders
                  WHERE product_id IS NOT NULL) op ON r.order_id = op.order_id
            GROUP BY op.product_id""",
        "sim_features": f"""
            SELECT p.product_id, p.category_english, {feats}
            FROM m_products_flat p
            LEFT JOIN sim_stats s ON p.product_id = s.product_id
            LEFT JOIN sim_reviews v ON p.product_id = v.product_id""",
        "sim_bounds": f"SELECT {bounds} FROM sim_features",
        "sim_scaled": f"""
            SELECT *, sqrt({squares}) AS norm FROM (
              SELECT product_id, category_english, avg_price, avg_review, order_count, review_count, {scaled}
              FROM sim_features, sim_bounds)""",
    }


def _label(col: str) -> str:
    return f"coalesce(nullif({col}, ''), 'unknown')"


def _cos_cols(a: str, b: str) -> str:
    dot = " + ".join(["CAST(0 AS DOUBLE)"] + [f"{a}.s_{f} * {b}.s_{f}" for f in SIM_FEATURES])
    return (f"(CASE WHEN {a}.norm * {b}.norm > 0 THEN ({dot}) / ({a}.norm * {b}.norm) "
            "ELSE CAST(0 AS DOUBLE) END)")


def sim_features() -> str:
    return with_model("SELECT * FROM sim_features", _sim_ctes())


def sim_scaled() -> str:
    return with_model("SELECT * FROM sim_scaled", _sim_ctes())


def sim_popular(n: int = 10) -> str:
    return with_model(f"""
SELECT product_id, {_label('category_english')} AS category,
       CAST(order_count AS BIGINT) AS order_count
FROM sim_features ORDER BY order_count DESC, product_id ASC LIMIT {n}""", _sim_ctes())


SIM_TARGET = {"sim_target": """
        SELECT * FROM sim_scaled WHERE product_id =
          (SELECT product_id FROM sim_features ORDER BY order_count DESC, product_id ASC LIMIT 1)"""}


def sim_target() -> str:
    return with_model(f"""
SELECT product_id, {_label('category_english')} AS category, avg_price, avg_review, review_count
FROM sim_target""", {**_sim_ctes(), **SIM_TARGET})


def sim_top_n(top_n: int = 10, digits: int = 6) -> str:
    return with_model(f"""
SELECT product_id, category, avg_price, avg_review, round(nearness, {digits}) AS similarity
FROM (SELECT s.product_id, {_label('s.category_english')} AS category, s.avg_price, s.avg_review,
             {_cos_cols('s', 't')} AS nearness
      FROM sim_scaled s, sim_target t
      WHERE s.product_id <> t.product_id
      ORDER BY nearness DESC NULLS LAST, s.product_id ASC
      LIMIT {top_n})""", {**_sim_ctes(), **SIM_TARGET})


def sim_unknown_id(product_id: int = -1, n_samples: int = 5) -> str:
    return with_model(f"""
SELECT 'sample' AS kind, product_id, {_label('category_english')} AS category,
       avg_price, avg_review, CAST(NULL AS DOUBLE) AS similarity
FROM sim_scaled
WHERE NOT EXISTS (SELECT 1 FROM sim_scaled WHERE product_id = {product_id})
ORDER BY product_id LIMIT {n_samples}""", _sim_ctes())


def sim_embeddings(top_n: int = 10, digits: int = 6) -> str:
    fold = "lambda p, q: p + q"
    dot = f"list_reduce(list_transform(range(1, len(e.v) + 1), lambda i: e.v[i] * t.v[i]), {fold})"
    norm = f"sqrt(list_reduce(list_transform(v, lambda x: x * x), {fold}))"
    return f"""
WITH e AS (SELECT *, {norm} AS n FROM (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
t AS (SELECT v, n FROM e WHERE vec_id = (SELECT min(vec_id) FROM e))
SELECT vec_id, label, round(nearness, {digits}) AS similarity
FROM (SELECT e.vec_id, e.label,
             CASE WHEN e.n * t.n > 0 THEN {dot} / (e.n * t.n) ELSE CAST(0 AS DOUBLE) END AS nearness
      FROM e, t
      WHERE e.vec_id <> (SELECT min(vec_id) FROM e)
      ORDER BY nearness DESC NULLS LAST, e.vec_id ASC
      LIMIT {top_n})"""


def adhoc() -> str:
    return with_model("""
SELECT p.category_english AS category, count(DISTINCT p.product_id) AS products,
       count(*) AS pieces, CAST(round(sum(CAST(o.price AS DECIMAL(28,8))), 2) AS DOUBLE) AS value
FROM m_orders o JOIN m_products_flat p ON o.product_id = p.product_id
WHERE p.weight_g >= 3000
GROUP BY p.category_english""")
