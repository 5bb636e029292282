"""Print the physical-plan lines that matter for scale (scans with pushed filters,
exchanges, join strategies, partial/final aggregates and group limits) for the
given registered queries: ``python tools/show_plans.py /root/testdata/sf0.01 pair_replies ...``."""

from __future__ import annotations

import sys

sys.path.insert(0, "/root/repo")

from parley.plans.registry import load_all  # noqa: E402
from parley.session import build_session  # noqa: E402

KEYS = ("FileScan", "Exchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoop",
        "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "WindowGroupLimit",
        "Window ", "TakeOrderedAndProject", "Generate", "MapInPandas", "InMemoryTableScan")


def main(sf_dir: str, names: list[str]) -> None:
    spark = build_session("local[4]")
    reg = load_all()
    for n in names or list(reg):
        plan = reg[n].build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(f"== {n}")
        for line in plan.split("\n"):
            if any(k in line for k in KEYS):
                print("  " + line[:200])


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
