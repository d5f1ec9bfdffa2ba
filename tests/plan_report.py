"""Write PLANS.md: the physical-plan shape of every registered query (before
adaptive re-planning) and what its Parquet scans push down and read.

    python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# queries that run fits or write artifacts while being built (their final plan
# is a read of written files, so the report shows little)
SKIP = {"artifact_roundtrip", "score_stream", "gated_publish", "tabular_pipeline", "classify_fit",
        "csv_ingest", "regress_fit", "score_batch", "tabular_hooks"}

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "Exchange RoundRobinPartitioning", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "Window", "Expand", "ObjectHashAggregate", "Generate", "TakeOrderedAndProject",
         "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def main(sf_dir):
    from __spark_entry__ import queries
    from featpipe.plans import ledger_queries, pipeline_queries
    from featpipe.session import local_session

    spark = local_session(8)
    lines = ["# Physical plans of the registered queries", "",
             f"Generated by `python tests/plan_report.py {sf_dir}` (plans before adaptive re-planning; "
             "AQE may still coalesce partitions or switch a join to broadcast at run time). "
             "Columns count plan nodes; the last three must stay 0.", "",
             "| query | shuffles (hash/range/single/round-robin) | broadcast | SMJ | BHJ | window | expand | "
             "object agg | explode | take-ordered | cartesian / nested-loop / python |",
             "|---|---|---|---|---|---|---|---|---|---|---|"]
    scans = []
    wanted = {name: fn for name, fn in queries().items()
              if name not in SKIP and name in {**ledger_queries.QUERIES, **pipeline_queries.QUERIES}}
    # the flagship writes its vectors before the caps: this is the plan of that write
    wanted["address_vectors (before its write)"] = ledger_queries._labelled
    for name, fn in wanted.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = {n: plan.count(n) for n in NODES}
        sh = "/".join(str(c[n]) for n in NODES[:4])
        bad = c["CartesianProduct"] + c["BroadcastNestedLoopJoin"] + c["BatchEvalPython"] + c["ArrowEvalPython"]
        lines.append(f"| {name} | {sh} | {c['BroadcastExchange']} | {c['SortMergeJoin']} | "
                     f"{c['BroadcastHashJoin']} | {c['Window']} | {c['Expand']} | {c['ObjectHashAggregate']} | "
                     f"{c['Generate']} | {c['TakeOrderedAndProject']} | {bad} |")
        for ln in plan.split("\n"):
            if "FileScan parquet" in ln:
                pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
                schema = re.search(r"ReadSchema: (struct<.*>)", ln)
                scans.append(f"| {name} | {(pushed.group(1) if pushed else '')[:90]} | "
                             f"`{(schema.group(1) if schema else '')[:110]}` |")
    lines += ["", "## Parquet scans", "", "| query | pushed filters | read schema |", "|---|---|---|"]
    lines += sorted(set(scans))
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print("wrote", out)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
