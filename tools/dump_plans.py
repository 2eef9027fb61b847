"""Write docs/PLANS.md: the final (post-AQE) physical plan of every driver query.

Each query is executed with the noop sink first so the adaptive plan is final.
Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from feedloom.plans.queries import QUERIES  # noqa: E402
from feedloom.session import local_session  # noqa: E402


def summary(plan: str) -> str:
    count = lambda pat: len(re.findall(pat, plan))
    return (f"shuffles {count(r'Exchange (hash|range|Single|round)')}, "
            f"broadcasts {count(r'BroadcastExchange')}, reused {count(r'Reused')}, "
            f"broadcast joins {count(r'BroadcastHashJoin')}, sort-merge joins {count(r'SortMergeJoin')}, "
            f"scans {count(r'Scan ')}")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    out = ["# Physical plans", "",
           f"Final adaptive plans of every registered query at `{os.path.basename(sf_dir)}`, "
           "captured by `tools/dump_plans.py` after running each query. Scratch paths are shortened.", ""]
    for key, query in QUERIES.items():
        df = query(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/tmp/[^\s,\]]*", "<scratch>", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {key}", "", summary(plan), "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
