"""Count exchanges, joins and Python evaluation in each query's physical plan.

Usage: python scripts/plan_summary.py [sf_dir]  -> a Markdown table on stdout.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.plans.catalog import QUERIES  # noqa: E402
from tillroll.session import get_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")     # the static plan, before AQE re-planning
    print("| query | shuffles | broadcasts | joins | window | python |")
    print("|---|---|---|---|---|---|")
    for name, fn in sorted(QUERIES.items()):
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        bcast = plan.count("BroadcastExchange")
        joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                      r"CartesianProduct)", plan)))
        window = "yes" if "Window " in plan or "Window [" in plan else ""
        python = "yes" if re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan) else ""
        print(f"| `{name}` | {shuffles} | {bcast} | {', '.join(joins)} | {window} | {python} |")
    spark.stop()


if __name__ == "__main__":
    main()
