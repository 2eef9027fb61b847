"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed with the ``noop`` sink (every row produced, no
driver collect).  A query's first run also pays JVM JIT and code-generation
warm-up, which swings single timings by up to ~2x on this machine, so every
query runs ``BENCH_RUNS`` times (default 2) and the best run is reported
(steady state); the cold first-run times are reported alongside.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from feedloom.plans.registry import QUERIES  # noqa: E402
from feedloom.session import local_session  # noqa: E402

HEADLINE = [
    "clean_interactions", "clean_items", "profile_reviews", "validation_findings_dirty",
    "label_summary", "dataset_summary", "top_items", "item_index", "encode_holdout",
    "lines_clean_interactions", "lines_clean_items", "lines_validation_findings", "lines_label_summary",
    "lines_dataset_summary", "lines_top_items", "lines_user_activity_histogram", "lines_profile_reviews",
    "lines_item_index", "jsonl_clean_interactions", "source_audit_totals",
]


def run(spark, key, sf_dir):
    t0 = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    keys = sys.argv[1:] or HEADLINE
    spark = local_session()
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    run(spark, "rating_counts", sf_dir)  # start the JVM side and the file listing cache
    times, cold, errors = {}, {}, {}
    for k in keys:
        try:
            samples = [run(spark, k, sf_dir) for _ in range(runs)]
        except Exception as e:  # noqa: BLE001 - report the failure, keep the JSON line
            times[k] = cold[k] = None
            errors[k] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        cold[k] = round(samples[0], 3)
        times[k] = round(min(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    ok = [v for v in times.values() if v is not None]
    out = {"metric": "total_query_seconds", "value": round(sum(ok), 3), "unit": "sec",
           "queries": times, "sf": sf, "runs_per_query": runs, "statistic": "min",
           "cold_total": round(sum(v for v in cold.values() if v is not None), 3), "cold_queries": cold}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
