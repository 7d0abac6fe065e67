"""Physical plan summaries: exchanges, joins, windows, scans and pushdown.

``python -m pitwise.plans.inspect /root/testdata/sf0.01 > PLANS.md`` writes a
table with one line per registered query.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import DataFrame

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")
_SCAN = re.compile(r"FileScan parquet (.*)")
_PART = {
    "table": re.compile(r"Location: [^\[]*\[[^\]]*?([^/\],]*?)(?:[\],]|\.\.\.)"),
    "pushed": re.compile(r"PushedFilters: \[(.*?)\](?:, ReadSchema|$)"),
    "read": re.compile(r"ReadSchema: (struct<.*)"),
}


def physical_plan(df: DataFrame) -> str:
    """The physical plan as planned before adaptive re-optimisation."""
    return df._jdf.queryExecution().executedPlan().toString()


def plan_summary(df: DataFrame) -> dict:
    plan = physical_plan(df)
    scans = []
    for line in plan.splitlines():
        m = _SCAN.search(line.strip())
        if m:
            found = {k: p.search(m.group(1)) for k, p in _PART.items()}
            scans.append({k: f.group(1) if f else "" for k, f in found.items()})
    return {
        "exchanges": plan.count("Exchange "),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "aggregates": plan.count("HashAggregate(") + plan.count("ObjectHashAggregate(") + plan.count("SortAggregate("),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans": scans,
        "forbidden": [f for f in FORBIDDEN if f in plan],
    }


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from pitwise.plans import registry
    from pitwise.plans.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of the registered queries\n")
    print(f"Planned on `{sf_dir}` with the settings of `pitwise/plans/session.py` (before adaptive")
    print("re-planning, which may later coalesce partitions, split skew or switch to broadcast).\n")
    print("| query | exchanges | SMJ | aggregates | windows | scans | forbidden nodes |")
    print("|---|---|---|---|---|---|---|")
    details = []
    for name, q in registry.queries().items():
        s = plan_summary(q(spark, sf_dir))
        print(
            f"| {name} | {s['exchanges']} | {s['sort_merge_joins']} | {s['aggregates']} | {s['windows']} | "
            f"{len(s['scans'])} | {', '.join(s['forbidden']) or 'none'} |"
        )
        details.append((name, s["scans"]))
    print("\n## Scans: columns read and filters pushed into parquet\n")
    for name, scans in details:
        print(f"### {name}\n")
        for sc in scans:
            print(f"- `{sc['table']}` reads `{sc['read']}`; pushed: `{sc['pushed'] or '-'}`")
        print()


if __name__ == "__main__":
    main(sys.argv[1:])
