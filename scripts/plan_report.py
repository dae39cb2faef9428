"""Write PLANS.md: the physical-plan shape of every catalog query that returns
a plan over the driver tables (storage/stream entries return reads of their
own output and are summarised by their job instead).

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editlens.plans import catalog, catalog_io  # noqa: E402
from editlens.session import build_session  # noqa: E402


def shape(plan: str) -> dict:
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange RoundRobinPartitioning", plan)),
        "single": plan.count("Exchange SinglePartition"),
        "broadcast": plan.count("BroadcastExchange"),
        "partial_agg": len(re.findall(r"functions=\[partial_", plan)),
        "topk": "TakeOrderedAndProject" in plan,
        "group_limit": "WindowGroupLimit" in plan,
        "python": "EvalPython" in plan,
        "scans": sorted(set(scans)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    io_names = {name for name, fn in catalog.QUERIES.items() if fn.__module__ == catalog_io.__name__}
    print("# Physical plan shapes\n")
    print("Generated by `scripts/plan_report.py` from `explain` of each catalog query "
          "(before AQE re-planning). `single` counts `Exchange SinglePartition`, used "
          "only by scalar subqueries / global aggregates of one row. Storage- and "
          "stream-backed entries are listed at the end.\n")
    print("| query | shuffles | single | broadcast | partial aggs | top-k | group limit "
          "| python | scan columns |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in catalog.QUERIES.items():
        if name in io_names:
            continue
        p = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = shape(p)
        cols = "; ".join(re.sub(r"struct<|>|:[a-z_0-9()]+", "", x) for x in s["scans"])
        print(f"| {name} | {s['shuffles']} | {s['single']} | {s['broadcast']} | "
              f"{s['partial_agg']} | {'yes' if s['topk'] else ''} | "
              f"{'yes' if s['group_limit'] else ''} | {'YES' if s['python'] else ''} | {cols} |")
    print("\nStorage / stream entries (plan is the job they run, then a read of its output): "
          + ", ".join(f"`{n}`" for n in sorted(io_names)) + ".")
    spark.stop()


if __name__ == "__main__":
    main()
