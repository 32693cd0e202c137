"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (the whole plan executes,
nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stellate.plans.registry import queries  # noqa: E402
from stellate.session import get_spark  # noqa: E402

HEADLINE = [
    "profile_lineitem",            # P16: wide aggregate + value-frequency shuffle
    "top_values_orders",           # P8-P10, W1
    "profile_many_tpch",           # P17 over seven tables
    "inclusion_dependencies",      # K15: data-driven join discovery
    "foreign_keys_inferred",       # K2 + K3 + K4
    "dedupe_latest_lineitem",      # D1
    "surrogate_key_orders",        # D2
    "build_dimension_customer",    # D5
    "fact_sales_lines",            # L1 + L4 with four lookups
    "fact_memberships",            # L2
    "fact_web_sessions",           # L9 skew-safe sessionisation
    "fact_web_pageviews",          # L10
    "gate_report",                 # Q9
    "quarantine_bad_rows",         # Q4
    "to_date_revenue",             # W5
    "prior_month_growth",          # W6 + W7
    "rollup_lines",                # A9
    "star_build_audit",            # dims -> bridge -> facts written, audited
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8), app_name="stellate-bench")
    qs = queries()
    times = {}
    # warm-up: JVM start, class loading, parquet footers, code generation paths
    for w in ("load_tables_counts", "profile_nation"):
        qs[w](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
