"""Summarise the physical plan of every registered query: shuffles,
broadcasts, scans (pushed filters, read schema), windows, aggregates and
whole-stage codegen.  Run: python tools/plan_report.py [sf_dir] [names...]

Queries that write intermediates while being built (the distributed index,
streams, model fits) run those steps; the plan shown is the final one.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candleflow.plans.catalogue import QUERIES  # noqa: E402
from candleflow.session import local_session  # noqa: E402

SKIP = {"compare_models", "stream_features", "stream_bars", "full_refresh"}


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    # AQE keeps the initial plan until execution; report that plan's nodes.
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group_limits": plan.count("WindowGroupLimit"),
        "aggregates": len(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan)),
        "python": len(re.findall(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)),
        "scans": re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in QUERIES if n not in SKIP]
    spark = local_session(8)
    for name in names:
        s = summary(QUERIES[name](spark, sf))
        scans = "; ".join(f"[{c[:60]}] pushed=[{p}]" for c, p in s.pop("scans"))
        print(f"{name}: " + ", ".join(f"{k}={v}" for k, v in s.items()))
        print(f"    scans: {scans}")


if __name__ == "__main__":
    main()
