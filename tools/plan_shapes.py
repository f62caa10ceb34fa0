"""Summarise the physical plan of every registered query.

    python tools/plan_shapes.py [sf_dir]

Prints a Markdown table: shuffle exchanges (hash / range / single
partition), broadcast exchanges, scalar subqueries (each evaluated once,
its own plan not counted in the other columns), Parquet/JSON scans, and
any Python evaluation node.  Plans are the final adaptive plans (each
query is collected first), with reused exchanges counted once.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _main_plan_lines(plan: str) -> tuple[list[str], set[str]]:
    """Lines of the plan outside subquery subtrees, and the subquery ids
    (a subquery is printed at every reference but evaluated once)."""
    kept, ids, skip_depth = [], set(), None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skip_depth is not None and depth > skip_depth:
            continue
        skip_depth = None
        m = re.search(r"Subquery subquery#(\d+)", line)
        if m and "+- Subquery" in line:
            ids.add(m.group(1))
            skip_depth = depth
            continue
        if "ReusedExchange" not in line:
            kept.append(line)
    return kept, ids


def shape(plan: str) -> dict:
    # An adaptive plan prints its final plan, then the initial one: keep the
    # top-level final plan (nested subquery plans have their own markers).
    plan = plan.split("\n+- == Initial Plan ==")[0]
    lines, subqueries = _main_plan_lines(plan)
    text = "\n".join(lines)
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", text)),
        "range": len(re.findall(r"Exchange rangepartitioning", text)),
        "single": len(re.findall(r"Exchange SinglePartition", text)),
        "broadcast": len(re.findall(r"BroadcastExchange", text)),
        "scans": len(re.findall(r"FileScan (parquet|json)", text)),
        "subqueries": len(subqueries),
        "python": bool(re.search(r"EvalPython|MapInPandas|FlatMapGroupsInPandas", plan)),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from wordstats.plans.catalog import QUERIES
    from wordstats.session import build_session

    spark = build_session("local[8]", 8)
    print("| query | hash shuffles | single-partition | broadcasts | scalar subqueries "
          "| scans | python |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()     # the frame's own execution: its final adaptive plan
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['hash'] + s['range']} | {s['single']} | {s['broadcast']} | "
              f"{s['subqueries']} | {s['scans']} | {'yes' if s['python'] else 'no'} |",
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
