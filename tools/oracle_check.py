"""Run every registered query on Spark and its DuckDB twin; compare results.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Compares row count, column names / types and an order-insensitive hash of
the values (exact, no float tolerance). Prints one line per query and a
summary; exit code 1 on any mismatch. With ``ORACLE_JSON=path`` set, the
per-query results are also written there as JSON.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from marketlens.session import get_session  # noqa: E402
from marketlens.sources.testdata import DRIVER_TABLES  # noqa: E402


TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT",
            "array<double>": "DOUBLE[]", "array<float>": "FLOAT[]"}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in v.items()) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def table_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import importlib.util
    spec = importlib.util.spec_from_file_location(
        "spark_entry", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                    "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    report = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows-only {name}: {len(srows)} rows ({ts:.1f}s)")
            report[name] = {"check": "rows-only", "rows": len(srows), "seconds": round(ts, 2)}
            continue
        try:
            cur = con.execute(sqls[name])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
            dtypes = [str(d[1]) for d in cur.description]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: duckdb error {e}")
            continue
        sh, sl = table_hash(scols, srows)
        dh, dl = table_hash(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
        status = "ok  " if ok else "FAIL"
        tmis = {c: (a, b) for c, a, b in zip(scols, stypes, [dict(zip(dcols, dtypes)).get(c) for c in scols])
                if TYPE_MAP.get(a, a) != b}
        tnote = f" TYPES {tmis}" if tmis else ""
        print(f"{status} {name}: rows {len(srows)}/{len(drows)} hash {sh}/{dh} ({ts:.1f}s){tnote}")
        report[name] = {"check": "oracle", "match": ok, "types_match": not tmis,
                        "rows": [len(srows), len(drows)], "hash": [sh, dh], "seconds": round(ts, 2)}
        if not ok:
            bad += 1
            if sorted(scols) != sorted(dcols):
                print("   cols spark", scols, "\n   cols duck ", dcols)
            print("   types spark", dict(zip(scols, stypes)), "\n   types duck ", dict(zip(dcols, dtypes)))
            sd = [x for x in sl if x not in set(dl)][:3]
            dd = [x for x in dl if x not in set(sl)][:3]
            print("   spark-only", sd, "\n   duck-only ", dd)
    print(f"mismatches: {bad}")
    if os.environ.get("ORACLE_JSON"):
        with open(os.environ["ORACLE_JSON"], "w") as fh:
            json.dump({"sf_dir": sf_dir, "mismatches": bad, "queries": report}, fh, indent=1)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
