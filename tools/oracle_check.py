"""Local stand-in for the driver's correctness gate.

Runs each registered Spark query and its DuckDB oracle on the same parquet files and
compares row count, column names and an order-insensitive hash of the values.
Usage: python tools/oracle_check.py [--sf DIR] [name-substring ...]
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stellate.plans.registry import oracle_sql, queries  # noqa: E402
from stellate.session import get_spark  # noqa: E402
from stellate.sources.tables import TABLES  # noqa: E402


def norm(v, digits):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, digits)) if digits is not None else repr(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x, digits) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x, digits)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i], digits) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--digits", type=int, default=None)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = get_spark()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if a.names and not any(s in name for s in a.names):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, a.sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in os_:
            print(f"ROWS-ONLY  {name}: rows={len(srows)} {ts:.1f}s")
            continue
        try:
            res = con.execute(os_[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL   {name}: {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        h1, l1 = digest(scols, srows, a.digits)
        h2, l2 = digest(dcols, drows, a.digits)
        ok = ok_cols and len(srows) == len(drows) and h1 == h2
        status = "OK        " if ok else "MISMATCH  "
        print(f"{status}{name}: rows {len(srows)}/{len(drows)} cols_ok={ok_cols} {ts:.1f}s")
        if not ok:
            bad += 1
            if not ok_cols:
                print("   spark:", sorted(scols), "\n   duck: ", sorted(dcols))
            else:
                s1, s2 = set(l1), set(l2)
                for x in sorted(s1 - s2)[:3]:
                    print("   spark-only:", x[:300])
                for x in sorted(s2 - s1)[:3]:
                    print("   duck-only: ", x[:300])
    print("bad:", bad)


if __name__ == "__main__":
    main()
