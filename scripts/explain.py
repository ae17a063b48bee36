"""Summarise the physical plan of each headline plan (writes PLANS.md).

Counts shuffles (Exchange), sorts, window operators and broadcasts in the
initial adaptive plan and lists the columns each parquet scan reads and the
filters pushed into it.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from heliospark.plans import catalog  # noqa: E402
from heliospark.session import build_session  # noqa: E402


def source(table: str, location: str) -> str:
    """A table of the test data, a bucketed table, or what a plan has written."""
    if table:
        return "stored " + re.sub(r"_[0-9a-f]{16}$", "", table.rpartition(".")[2])
    name = re.search(r"/(\w+)\.parquet", location)
    return name.group(1) if name else "written " + re.sub(r"-[0-9a-f]{12}.*|\.\.\..*", "", location.rpartition("/tables/")[2])


def summary(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "sorts": len(re.findall(r"\bSort \[", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans": sorted(
            {
                f"{source(m.group(1), m.group(3))}: " + ",".join(re.sub(r"#\d+L?", "", c) for c in m.group(2).split(","))
                for m in re.finditer(r"FileScan parquet ([\w.]*) ?\[([^\]]*)\][^\n]*?Location: \w+\([^)]*\)\[([^\]]*)", plan)
            }
            | {f"checkpointed rows: {len(m.group(1).split(','))} columns" for m in re.finditer(r"Scan ExistingRDD\[([^\]]*)\]", plan)}
        ),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]\n]+)", plan))),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    catalog.load_all()
    lines = [
        "# Physical plans of the headline queries",
        "",
        f"Generated by `scripts/explain.py` on `{sf}` (initial adaptive plans; AQE may",
        "coalesce partitions or switch joins at run time). Shuffles count Exchange",
        "nodes; scans list the columns read per table.",
        "",
        "| plan | shuffles | broadcasts | sorts | windows | columns read | pushed filters |",
        "| --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name in HEADLINE:
        if name in ("gbt_train_score", "feature_importance"):
            continue  # their work is the fitting of models before the plan
        df = catalog.QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        pushed = "; ".join(p for p in s["pushed"] if p) or "-"
        lines.append(
            f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['sorts']} | {s['windows']} | "
            f"{'<br>'.join(s['scans'])} | {pushed} |"
        )
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
