"""Command line: the entry points a user of the modelled system runs.

    python -m marketlens convert RAW_DIR OUT_DIR        # nine CSVs -> five datasets
    python -m marketlens convert-testdata SF_DIR OUT_DIR
    python -m marketlens tables OUT_DIR [--database D]  # external tables + repair
    python -m marketlens report NAME OUT_DIR [k=v ...]  # q1..q8, n1..n8, overview
    python -m marketlens sql OUT_DIR "SELECT ..."       # ad-hoc SQL over the views
    python -m marketlens similar OUT_DIR [PRODUCT_ID] [--top N]
    python -m marketlens formats OUT_DIR YEAR MONTH     # CSV / JSON / Parquet reads
    python -m marketlens check OUT_DIR [--min-rows orders=90000 ...] [--review-partitions 5]
    python -m marketlens explain NAME OUT_DIR           # plan + partitions read
    python -m marketlens schema OUT_DIR                 # tables, columns, struct fields

Results are shown with ``DataFrame.show`` (bounded output); nothing else is
brought to the driver. ``tables`` registers into the session's catalog, which
outlives the process only when Spark runs with a persistent (Hive) metastore.
"""

from __future__ import annotations

import argparse
import ast
import sys
import time

REPORTS = {
    "q1": "revenue_trend", "q2": "top_categories", "q2n": "top_categories_nested",
    "q3": "cohort_retention", "q4": "low_reviews", "q5": "geo_revenue",
    "q6": "delivery_vs_reviews", "q7": "top_states", "q8": "one_year",
    "n1": "top_categories_by_revenue", "n2": "revenue_by_year", "n3": "payment_share",
    "n4": "worst_review_states", "n5": "one_star_categories",
    "n6": "top_categories_in_quarter", "n7": "top_categories_in_year",
    "n8": "states_by_orders_in_quarter", "overview": "overview",
}


def _params(items: list[str]) -> dict:
    out = {}
    for it in items:
        k, _, v = it.partition("=")
        try:
            out[k] = ast.literal_eval(v)
        except (ValueError, SyntaxError):
            out[k] = v
    return out


#: Rows printed unless --limit says otherwise; --out always writes all.
PRINT_ROWS = 1000
#: Width of a category in printed similarity lists.
CATEGORY_WIDTH = 29


def _deliver(df, out: str | None, limit: int | None) -> None:
    """Write the whole result with Spark, or print up to ``limit`` rows."""
    if out:
        from marketlens.sinks.parquet import write_json

        write_json(df, out)
        print(f"written to {out}")
        return
    limit = PRINT_ROWS if limit is None else limit
    rows = df.limit(limit + 1).collect()  # one more than printed, to know if there are more
    shown = df.sparkSession.createDataFrame(rows[:limit], df.schema)
    shown.show(max(1, limit), truncate=False)
    if len(rows) > limit:
        print(f"only {limit} rows are shown; use --limit N or --out PATH for more")


def _short(df):
    """The category cut to the width of a printed list."""
    from pyspark.sql import functions as F

    return df.withColumn("category", F.substring("category", 1, CATEGORY_WIDTH))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="marketlens")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("convert")
    c.add_argument("raw_dir")
    c.add_argument("out_dir")
    ct = sub.add_parser("convert-testdata")
    ct.add_argument("sf_dir")
    ct.add_argument("out_dir")
    tb = sub.add_parser("tables")
    tb.add_argument("out_dir")
    tb.add_argument("--database", default="marketlens")
    r = sub.add_parser("report")
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("out_dir")
    r.add_argument("params", nargs="*", help="k=v parameters, e.g. years=(2017,2018)")
    q = sub.add_parser("sql")
    q.add_argument("out_dir")
    q.add_argument("query")
    for p in (r, q):
        p.add_argument("--out", default=None, help="write the whole result as JSON lines to this folder")
        p.add_argument("--limit", type=int, default=PRINT_ROWS,
                       help="rows to print (default %(default)s); a note tells if there are more")
    s = sub.add_parser("similar")
    s.add_argument("out_dir")
    s.add_argument("product_id", nargs="?")
    s.add_argument("--top", type=int, default=10)
    f = sub.add_parser("formats")
    f.add_argument("out_dir")
    f.add_argument("year", type=int)
    f.add_argument("month", type=int)
    f.add_argument("--iterations", type=int, default=3)
    f.add_argument("--out", default=None, help="also write the timings as JSON lines here")
    k = sub.add_parser("check")
    k.add_argument("out_dir")
    k.add_argument("--min-rows", nargs="*", default=[],
                   help="table=n minimums, e.g. orders=90000 products=30000")
    k.add_argument("--review-partitions", type=int, default=None,
                   help="expected number of review_score partitions (5 for scores 1-5)")
    sc = sub.add_parser("schema")
    sc.add_argument("out_dir")
    e = sub.add_parser("explain")
    e.add_argument("name", choices=sorted(REPORTS))
    e.add_argument("out_dir")
    e.add_argument("params", nargs="*")
    a = ap.parse_args(argv)

    from marketlens.session import get_session

    spark = get_session(a.master)
    from marketlens.plans import measure as M
    from marketlens.plans import reports as R
    from marketlens.sources import catalog as C
    from marketlens.sources import warehouse as W

    if a.cmd in ("convert", "convert-testdata"):
        if a.cmd == "convert":
            from marketlens.sources.files import raw_csv_inputs
            raw = raw_csv_inputs(spark, a.raw_dir)
        else:
            from marketlens.sources.testdata import raw_inputs
            raw = raw_inputs(spark, a.sf_dir)
        from marketlens.session import apply_scale_conf

        src = a.raw_dir if a.cmd == "convert" else a.sf_dir
        size = M.list_files(spark, src).agg({"length": "sum"}).first()[0] or 0
        apply_scale_conf(spark, int(size))
        t0 = time.perf_counter()
        W.build_warehouse(raw, a.out_dir)
        print(f"converted in {time.perf_counter() - t0:.1f}s -> {a.out_dir}")
        t = W.open_tables(spark, a.out_dir)
        R.overview(t).show(truncate=False)
        datasets = {("parquet", n): (W.dataset_path(a.out_dir, n), "*.parquet") for n in W.TABLES}
        M.storage_footprint(spark, datasets).show(truncate=False)
        return 0

    t = W.open_tables(spark, a.out_dir)
    if a.cmd == "tables":
        C.create_namespace(spark, a.database)
        for name, fq in C.register_warehouse(spark, a.database, a.out_dir).items():
            print(name, "->", fq)
        return 0
    if a.cmd in ("report", "explain"):
        df = getattr(R, REPORTS[a.name])(t, **_params(a.params))
        if a.cmd == "explain":
            print(M.plan_text(df))
            return 0
        t0 = time.perf_counter()
        _deliver(df, a.out, a.limit)
        print(f"{time.perf_counter() - t0:.2f}s")
        return 0
    if a.cmd == "sql":
        _deliver(R.run_sql(spark, t, a.query), a.out, a.limit)
        return 0
    if a.cmd == "similar":
        from marketlens.operators import similarity as S

        if a.product_id is None:
            print("Popular products (pick one):")
            _short(S.popular_products(S.feature_table(t), 10)).show(truncate=False)
            return 0
        # the id's type follows the table (hex strings in the raw data, longs
        # in the test data); never guess it from the text
        id_type = t.products.schema["product_id"].dataType.simpleString()
        pid = a.product_id if id_type == "string" else int(a.product_id)
        scaled = S.scaled_table(t)
        _short(S.target_product(scaled, pid)).show(truncate=False)
        _short(S.find_similar(scaled, pid, a.top)).show(a.top + 5, truncate=False)
        return 0
    if a.cmd == "formats":
        times = M.format_read_times(spark, t, a.year, a.month, a.iterations)
        times.show(truncate=False)
        if a.out:
            from marketlens.sinks.parquet import write_json
            write_json(times.coalesce(1), a.out)  # a handful of metric rows
        return 0
    if a.cmd == "schema":
        _deliver(C.schema_catalogue(spark, t.as_dict()), None, None)
        return 0
    if a.cmd == "check":
        mins = {k: int(v) for k, v in _params(a.min_rows).items()}
        out = M.dataset_checks(spark, t, min_rows=mins, review_partitions=a.review_partitions)
        out.show(50, truncate=False)
        return 0 if all(r.ok for r in out.collect()) else 1
    return 2


if __name__ == "__main__":
    sys.exit(main())
