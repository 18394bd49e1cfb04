"""Benchmark the headline queries.

Runs each query of HEADLINE at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then ``$BENCH_RUNS`` (default 3) timed runs,
each fully executed into Spark's ``noop`` sink (no driver collect). Prints one
JSON line with the median seconds per query and their sum.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stocktake.plans.queries import QUERIES  # noqa: E402
from stocktake.session import build_session  # noqa: E402

HEADLINE = [
    "analysis_full",
    "orders_analysis",
    "all_accounts",
    "combine_full_outer",
    "rekey",
    "unmapped_objects",
    "listing_with_placeholders",
    "listing_subfolders",
    "listing_duplicate_keys",
    "map_duplicates",
    "pending_accounts",
    "full_diff_written",
    "full_diff_csv",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    results = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)  # warm-up (JIT, file listing cache)
        results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
