"""Summarise the physical plan of every registered query (markdown table).

Usage: ``python tests/plan_report.py [sf_dir]``.  Counts come from the plan
Spark prepares before running (AQE may still turn a sort-merge join into a
broadcast join, or split a skewed partition, at run time).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

CHECKS = {
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "python_udf": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF)",
    "cartesian": r"(CartesianProduct|BroadcastNestedLoopJoin)",
    "single_partition": r"Exchange SinglePartition",
}


def summarise(plan: str) -> dict[str, int]:
    return {k: len(re.findall(p, plan)) for k, p in CHECKS.items()}


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from jobnest.session import get_session
    import __spark_entry__ as entry

    spark = get_session("local[8]", 8)
    cols = list(CHECKS)
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, q in entry.queries().items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
