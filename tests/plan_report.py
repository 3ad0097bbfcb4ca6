"""Summarise the physical plans of the headline jobs (writes PLANS.md).

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOBS = ["fact_book", "edition_clean", "dim_edition", "dim_subject", "work_subject", "work_author",
        "dim_time", "merge_upsert", "dedup_latest", "salted_agg", "frontier_anti", "check_keys",
        "null_profile", "surrogate_key"]


def summarise(plan: str) -> dict:
    c = Counter()
    for m in re.finditer(r"Exchange (hashpartitioning\(([^)]*)\)|SinglePartition|rangepartitioning\(([^)]*)\)|RoundRobinPartitioning\(\d+\))", plan):
        kind = m.group(1)
        if kind.startswith("hashpartitioning"):
            cols = re.sub(r"#\d+L?", "", m.group(2)).split(",")[:-1]
            c[f"hash({', '.join(x.strip() for x in cols[:3])}{', ...' if len(cols) > 3 else ''})"] += 1
        elif kind.startswith("rangepartitioning"):
            c["range"] += 1
        else:
            c[kind.split("(")[0]] += 1
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|FullOuter|RightOuter)", plan))
    aggs = Counter(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan))
    win = len(re.findall(r"\bWindow\b", plan))
    py = len(re.findall(r"EvalPython|InPandas", plan))
    return {"exchanges": dict(c), "joins": {f"{a} {b}": n for (a, b), n in joins.items()},
            "aggregates": dict(aggs), "windows": win, "python": py}


def main():
    from pyspark.sql import SparkSession

    from bookmart.plans import jobs
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the headline jobs\n")
    print(f"Generated by `python tests/plan_report.py {sf}` from each job's executed plan before")
    print("adaptive re-planning (AQE may later coalesce partitions, split skew or switch a join to")
    print("broadcast from runtime sizes). Subquery plans are included; a spread of a narrow scan")
    print("(one-row-group input files) shows as an extra hash exchange on all columns.\n")
    print("| Job | Exchanges | Joins | Aggregates | Windows | Python |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name in JOBS:
        p = jobs.JOBS[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarise(p)
        fmt = lambda d: ", ".join(f"{k} x{v}" for k, v in d.items()) or "-"
        print(f"| {name} | {fmt(s['exchanges'])} | {fmt(s['joins'])} | {fmt(s['aggregates'])} "
              f"| {s['windows']} | {s['python']} |")


if __name__ == "__main__":
    main()
