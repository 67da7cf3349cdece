"""Per-query plan summary of every named query, in the shape a large run
takes (broadcast joins off unless written explicitly for a bounded set).

Usage: python tools/plan_report.py [sf_dir] > docs/plan_report.md
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from reachset.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from reachset.plans.named import QUERIES

    spark = build_session(
        extra={
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.maxMetadataStringLength": "10000",
        }
    )
    print("| query | scans | shuffles | sort-merge joins | broadcast joins (bounded sets) "
          "| pushed filters | python |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        scans = final.count("FileScan")
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", final))
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", final))
        smj = final.count("SortMergeJoin")
        bhj = final.count("BroadcastHashJoin")
        py = "yes" if ("EvalPython" in final or "PythonUDF" in final) else "no"
        print(f"| {name} | {scans} | {shuffles} | {smj} | {bhj} | {pushed}/{scans} | {py} |")
    spark.stop()


if __name__ == "__main__":
    main()
