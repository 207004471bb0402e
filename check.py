"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import math
import sys
import time

import duckdb

from quill.plans.registry import load_all
from quill.session import local_session
from quill.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def main(argv):
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    results = {}
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf)
            cols = sorted(df.columns)
            rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:400]}"
            print(name, results[name], flush=True)
            continue
        dt = time.time() - t0
        if not q.sql:
            results[name] = f"rows-only {len(rows)}"
            print(name, results[name], f"{dt:.1f}s", flush=True)
            continue
        try:
            rel = con.execute(q.sql)
            dcols = [d[0] for d in rel.description]
            drows_raw = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(e)[:400]}"
            print(name, results[name], flush=True)
            continue
        order = sorted(range(len(dcols)), key=lambda i: dcols[i])
        drows = [tuple(_norm(r[i]) for i in order) for r in drows_raw]
        same_cols = cols == sorted(dcols)
        key = lambda r: json.dumps(r, default=str, sort_keys=True)
        ok = same_cols and sorted(map(key, rows)) == sorted(map(key, drows))
        results[name] = "OK" if ok else "MISMATCH"
        print(name, results[name], len(rows), len(drows), f"{dt:.1f}s", flush=True)
        if not ok:
            if not same_cols:
                print("  cols", cols, sorted(dcols))
            a, b = set(map(key, rows)), set(map(key, drows))
            print("  spark-only", list(a - b)[:3])
            print("  duck-only ", list(b - a)[:3])
    bad = [n for n, r in results.items() if not (r == "OK" or r.startswith("rows-only"))]
    print("SUMMARY", len(results), "checked,", len(bad), "bad:", bad)


if __name__ == "__main__":
    main(sys.argv)
