"""Time DuckDB running the oracle SQL of the bench headline queries (single-node reference point)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from stellate.plans.registry import oracle_sql  # noqa: E402
from stellate.sources.tables import TABLES  # noqa: E402


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    threads = int(os.environ.get("BENCH_CPUS", "8"))
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sqls = oracle_sql()
    times = {}
    for name in HEADLINE:
        if name not in sqls:
            continue
        t0 = time.time()
        con.execute(sqls[name]).fetchall()
        times[name] = round(time.time() - t0, 3)
    print(json.dumps({"engine": "duckdb", "value": round(sum(times.values()), 3), "queries": times,
                      "sf": os.path.basename(sf).replace("sf", ""), "threads": threads}))


if __name__ == "__main__":
    main()
