"""Summarise the final (adaptive) physical plan of every session-analytics query.

    python tools/plan_summary.py [sf_dir] > docs/PLANS.md

For each query: its shuffles (partitioning keys), joins (strategy, type),
windows and aggregates, and the parquet scans with their read schema and
pushed filters. The query is executed first, so AQE decisions (broadcast
conversions, coalesced partitions) are the real ones.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from visitlens.plans import catalog  # noqa: E402
from visitlens.session import build_session  # noqa: E402

_ID = re.compile(r"#\d+L?")


def clean(text: str) -> str:
    return _ID.sub("", text)


def summarise(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"^\*\(\d+\)\s*", "", clean(line.strip(" :+-")))
        if line.startswith("Exchange"):
            m = re.match(r"Exchange (hashpartitioning\((.*), \d+\)|rangepartitioning\((.*), \d+\)|SinglePartition)", line)
            if m and m.group(2):
                out.append(f"shuffle hash({m.group(2)})")
            elif m and m.group(3):
                out.append(f"shuffle range({m.group(3)})")
            else:
                out.append("shuffle " + (m.group(1) if m else line.split(",")[0]))
        elif line.startswith("BroadcastExchange"):
            out.append("broadcast exchange")
        elif line.startswith("ReusedExchange"):
            out.append("reused exchange")
        elif line.startswith(("SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "ShuffledHashJoin")):
            kind = line.split(" ")[0]
            jtype = next((t for t in ("LeftSemi", "LeftOuter", "LeftAnti", "Inner") if t in line), "")
            out.append(f"join {kind} {jtype}".strip())
        elif line.startswith("Window ["):
            m = re.search(r"windowspecdefinition\(([^,]*(?:, [^,]*)*?)(?:, [^,]* (?:ASC|DESC))", line)
            out.append("window" + (f" partition by {m.group(1)}" if m else ""))
        elif line.startswith("WindowGroupLimit"):
            out.append("window group limit " + ("partial" if "Partial" in line else "final"))
        elif line.startswith("TakeOrderedAndProject"):
            out.append("top-k (TakeOrderedAndProject)")
        elif line.startswith(("HashAggregate", "ObjectHashAggregate", "SortAggregate")):
            kind = line.split("(")[0]
            keys = re.search(r"keys?=\[([^\]]*)\]", line)
            part = "partial " if "partial_" in line else ""
            out.append(f"{part}{kind} by [{keys.group(1) if keys else ''}]")
        elif line.startswith("FileScan parquet"):
            table = re.search(r"/([a-z_]+)\.parquet", line)
            name = table.group(1) if table else ("user_visit_action (stored)" if "visitlens-t" in line else "?")
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            parts = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", line)
            out.append(
                f"scan {name} [{cols.group(1) if cols else ''}]"
                + (f" partitions: {parts.group(1)}" if parts and parts.group(1) else "")
                + (f" pushed: {pushed.group(1)}" if pushed and pushed.group(1) else "")
            )
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Physical plans (final adaptive plans)\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}`, local[8], 16 shuffle partitions, AQE on.")
    print("Lines are operators from the root down; ids removed. At this size AQE turns joins with a")
    print("small side into broadcasts; on large inputs the same plans keep their sort-merge joins.\n")
    for name, query in catalog.queries().items():
        df = query(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        print(f"## `{name}`\n")
        print("```")
        for item in summarise(final):
            print(item)
        print("```\n")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
