"""Summarise the final (adaptive) physical plan of every registered query:
shuffles, join strategies, aggregates, scans and their pruned read schemas.

usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from storelens.queries import QUERIES  # noqa: E402
from storelens.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"\bExchange hashpartitioning|\bExchange RoundRobin|\bExchange SinglePartition|\bExchange rangepartitioning",
    "broadcast joins": r"\bBroadcastHashJoin\b",
    "sort-merge joins": r"\bSortMergeJoin\b",
    "shuffled hash joins": r"\bShuffledHashJoin\b",
    "nested-loop joins": r"\bBroadcastNestedLoopJoin\b|\bCartesianProduct\b",
    "hash aggregates": r"\bHashAggregate\b",
    "top-k (TakeOrderedAndProject)": r"\bTakeOrderedAndProject\b",
    "python UDF nodes": r"\bBatchEvalPython\b|\bArrowEvalPython\b|\bFlatMapGroupsInPandas\b",
}


def final_only(plan: str) -> str:
    """Drop every '== Initial Plan ==' block (AQE prints it after the final
    plan, also inside subqueries): skip the lines nested under the marker."""
    out, skip_col = [], None
    for line in plan.splitlines():
        if skip_col is not None:
            if len(line) > skip_col and line[skip_col] == " ":
                continue
            skip_col = None
        i = line.find("+- == Initial Plan ==")
        if i >= 0:
            skip_col = i
            continue
        out.append(line)
    return "\n".join(out)


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, final adaptive plans)\n")
    print("Generated by `tools/plans.py`. Counts are operators in the executed plan "
          "(AQE has already re-planned joins from measured sizes); `reused` counts "
          "exchanges shared by two branches.\n")
    header = ["query"] + list(PATTERNS) + ["reused", "scans (read columns)"]
    print("| " + " | ".join(header) + " |")
    print("|" + "---|" * len(header))
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df.collect() if name not in ("dashboard_frame",) else df.count()
        plan = final_only(df._jdf.queryExecution().executedPlan().toString())
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        reused = str(plan.count("ReusedExchange"))
        scans = re.findall(r"FileScan (\w+) \[([^\]]*)\]", plan)
        scan_txt = "; ".join(f"{fmt}: {len(cols.split(','))} cols" for fmt, cols in scans) or "–"
        print("| " + " | ".join([name] + counts + [reused, scan_txt]) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
