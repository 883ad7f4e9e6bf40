"""Summarise the physical plan of every registered query (after execution, AQE
final plan): shuffles, broadcasts, top-k pushdown, Python nodes, pushed
filters. Writes a Markdown table to stdout.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PY = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pagewright.session import build_session, checkpoint_dir
    from pagewright.plans.catalog import QUERIES
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false"})
    checkpoint_dir(spark, os.environ.get("WORK_DIR"))  # else the session's warehouse
    print(f"# Physical plans of the registered queries\n\nGenerated by `scripts/plan_report.py {sf}` "
          f"(Spark {spark.version}, AQE final plans, 8 shuffle partitions). "
          "Counts are operators in the final executed plan of the returned DataFrame. At this size AQE "
          "turns most joins into broadcasts; at scale the same exchanges stay sort-merge shuffles. "
          "Fixture derivation from the driver tables is part of every plan. Jobs a query runs "
          "before returning (the stage tables of the pipeline runs) are not included.\n")
    print("| Query | shuffles | reused shuffles | broadcasts | sort-merge joins | WindowGroupLimit | Python | cartesian |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for k in sorted(QUERIES):
        df = QUERIES[k](spark, sf)
        df.collect()  # an action on this DataFrame, so its AQE plan is final
        p = df._jdf.queryExecution().executedPlan().toString()
        if "== Final Plan ==" in p:
            p = p.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        lines = p.split("\n")
        shuffles = sum(1 for ln in lines if re.search(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|"
                                                      r"SinglePartition)", ln) and "Reused" not in ln)
        reused = sum("ReusedExchange" in ln for ln in lines)
        bc = sum("BroadcastExchange" in ln and "Reused" not in ln for ln in lines)
        smj = p.count("SortMergeJoin")
        wgl = "yes" if "WindowGroupLimit" in p else ""
        py = ", ".join(sorted({n for n in PY if n in p}))
        cart = "YES" if ("CartesianProduct" in p or "BroadcastNestedLoopJoin" in p) else ""
        print(f"| `{k}` | {shuffles} | {reused} | {bc} | {smj} | {wgl} | {py} | {cart} |")
    spark.stop()


if __name__ == "__main__":
    main()
