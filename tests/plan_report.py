"""Summarize the physical plan of every registered telemetry query, with broadcasts and AQE off.

Usage: python tests/plan_report.py [sf_dir]  -> markdown table on stdout.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _fresh(lines, pattern):
    """Operators that run (a ReusedExchange line names the exchange it reuses)."""
    return sum(1 for ln in lines if re.search(pattern, ln) and "ReusedExchange" not in ln)


def summarize(text: str) -> dict:
    lines = text.splitlines()
    return {
        "hash shuffles": _fresh(lines, r"Exchange hashpartitioning"),
        "reused": sum(1 for ln in lines if "ReusedExchange" in ln),
        "round-robin": _fresh(lines, r"RoundRobinPartitioning"),
        "SMJ": text.count("SortMergeJoin"),
        "BHJ": text.count("BroadcastHashJoin"),
        "Window": len(re.findall(r"\bWindow \[", text)),
        "GroupLimit": text.count("WindowGroupLimit"),
        "TopN": text.count("TakeOrderedAndProject"),
        "Python": len(re.findall(r"ArrowEvalPython|FlatMapGroupsInPandas", text)),
        "event scans": len(re.findall(r"FileScan parquet.*events", text)),
        "pushed filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", text)),
    }


if __name__ == "__main__":
    from shopfloor.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    # the shape at scale: no join is small enough to broadcast, nothing is re-planned
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    import __spark_entry__ as E
    from shopfloor.plans import catalog
    rows = {name: summarize(planned(fn(spark, sf))) for name, fn in E.queries().items()
            if name in catalog.QUERIES}
    cols = list(next(iter(rows.values())))
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, r in rows.items():
        print(f"| {name} | " + " | ".join(str(r[c]) for c in cols) + " |")
