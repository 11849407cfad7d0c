"""Run every registered query in Spark and its oracle SQL in DuckDB and
compare row count, column names and order-insensitive values.

usage: python tools/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from jobsift import fixtures  # noqa: E402
from jobsift.registry import ORACLE, QUERIES, load_all  # noqa: E402
from jobsift.session import get_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, "" if x is None else str(type(x)), x if x is not None else 0) for x in row)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    load_all()
    spark = get_session()
    con = duckdb.connect()
    for t in fixtures.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, fn in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            scols = sdf.columns
            srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time() - t0
        if name not in ORACLE:
            print(f"ROWS {name}: {len(srows)} rows ({t1:.1f}s), no oracle")
            continue
        try:
            res = con.sql(ORACLE[name])
            dcols = res.columns
            drows = [tuple(norm(x) for x in r) for r in res.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        if scols != dcols:
            print(f"FAIL {name}: columns differ\n  spark {scols}\n  duck  {dcols}")
            bad += 1
            continue
        order = sorted(range(len(scols)), key=lambda i: scols[i])
        s_sorted = sorted((tuple(r[i] for i in order) for r in srows), key=key)
        d_sorted = sorted((tuple(r[i] for i in order) for r in drows), key=key)
        if s_sorted != d_sorted:
            print(f"FAIL {name}: values differ ({len(srows)} vs {len(drows)} rows)")
            sset = {}
            for r in s_sorted:
                sset[r] = sset.get(r, 0) + 1
            for r in d_sorted:
                sset[r] = sset.get(r, 0) - 1
            diffs = [(r, n) for r, n in sset.items() if n != 0][:6]
            cols = [scols[i] for i in order]
            for r, n in diffs:
                print("   ", "spark-only" if n > 0 else "duck-only", dict(zip(cols, r)))
            bad += 1
        else:
            print(f"OK   {name}: {len(srows)} rows ({t1:.1f}s)")
            ok += 1
    print(f"ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
