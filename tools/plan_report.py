"""Summarise the executed (final AQE) plan of every registered query.

    python tools/plan_report.py [sf_dir] > PLANS.md

For each query: shuffles (hash / range / single partition), join
strategies, partial group limits, window operators, scans with the columns
they read and the filters pushed to Parquet.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def summarize(plan: str) -> dict:
    lines = plan.split("\n")
    count = lambda pat: sum(1 for line in lines if re.search(pat, line))
    # the plan text may cut a long filter list with "..." before the bracket
    pushed = [m.rstrip("]") for m in re.findall(r"PushedFilters: \[(.*?)(?:\]|, ReadSchema)", plan)]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return {
        "hash_shuffles": count(r"Exchange hashpartitioning"),
        "range_shuffles": count(r"Exchange rangepartitioning"),
        "single_partition": count(r"Exchange SinglePartition"),
        "broadcast_joins": count(r"BroadcastHashJoin"),
        "sort_merge_joins": count(r"SortMergeJoin"),
        "shuffled_hash_joins": count(r"ShuffledHashJoin"),
        "nested_loop_or_cartesian": count(r"NestedLoopJoin|CartesianProduct"),
        "group_limits_partial": count(r"WindowGroupLimit.*Partial"),
        "windows": count(r"^\s*[:+\- ]*Window \["),
        "top_k": count(r"TakeOrderedAndProject"),
        "scans": plan.count("FileScan "),
        "reused": plan.count("ReusedExchange"),
        "max_columns_read": max((s.count(":") for s in schemas), default=0),
        "pushed": sorted({p for p in pushed if p and p != "IsNotNull"}),
    }


def final_plan(df) -> str:
    """Run the DataFrame's own physical plan and return its final (AQE) text.

    ``df.write...`` would run a separate query execution and leave this one
    at its initial plan.
    """
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString().split("== Initial Plan ==")[0]  # the text also lists the initial plan


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from indicata.plans.registry import QUERIES
    from indicata.session import get_spark
    spark = get_spark("plan-report", master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Executed plans ({sf_dir}, local[8], AQE final plans)\n")
    print("Generated by `tools/plan_report.py`. Shuffle counts are exchanges "
          "actually run; a shuffle AQE reused is counted under `reused`, not again; `SinglePartition` "
          "exchanges are final merges of one-row partial aggregates or per-partition "
          "statistics, never data rows.\n")
    print("| query | hash shuffles | range | single | reused | bcast joins | SMJ | group limits (partial) | "
          "windows | top-k | scans | max cols read |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|")
    pushed_rows = []
    for key, q in QUERIES.items():
        s = summarize(final_plan(q(spark, sf_dir)))
        bad = " **(!)**" if s["nested_loop_or_cartesian"] else ""
        print(f"| `{key}`{bad} | {s['hash_shuffles']} | {s['range_shuffles']} | {s['single_partition']} | "
              f"{s['reused']} | "
              f"{s['broadcast_joins']} | {s['sort_merge_joins'] + s['shuffled_hash_joins']} | "
              f"{s['group_limits_partial']} | {s['windows']} | {s['top_k']} | {s['scans']} | "
              f"{s['max_columns_read']} |", flush=True)
        if s["pushed"]:
            pushed_rows.append((key, s["pushed"]))
    print("\n## Filters pushed to the Parquet reader\n")
    for key, pushed in pushed_rows:
        print(f"* `{key}`: " + "; ".join(p[:160] for p in pushed))


if __name__ == "__main__":
    main(sys.argv)
