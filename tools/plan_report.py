"""Physical-plan summary of every registered query (writes PLANS.md).

For each query: scans with the columns they read, shuffles, broadcasts,
sort-merge joins, windows, and red flags (Cartesian products, nested-loop
joins, sort-based aggregation, Python UDF evaluation). Plans are taken
after a run through the no-op sink, so AQE's final choices are shown.

    python tools/plan_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lapse import catalog  # noqa: E402
from lapse.operators import materialize  # noqa: E402
from lapse.session import build_session  # noqa: E402

# Fits take minutes; their inputs are the plans of user_features and the encodings.
MODEL_QUERIES = {
    "cluster_sizes", "cluster_coverage", "scaled_features", "class_weights", "feature_preview", "stage_shapes", "oof_predictions",
    "oof_coverage", "forest_confusion", "forest_macro_f1", "test_predictions", "test_coverage", "forest_distribution",
}
RED_FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "BatchEvalPython", "ArrowEvalPython")


def scans_of(plan: str) -> list[tuple[str, list[str]]]:
    """(table, columns) of every parquet scan; landed tables as ``landed:<name>``."""
    found = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: \w+(?:\(\d+ paths\))? ?\[([^\]]*)", plan)
    out = []
    for cols, where in found:
        landed = re.search(r"lapse-tables/[^/]+/([a-z]+(?:-[a-z]+)*)-[0-9a-f]", where)
        source = re.search(r"/(\w+)\.parquet", where)
        name = f"landed:{landed[1]}" if landed else source[1] if source else "?"
        out.append((name, [c.strip().split("#")[0] for c in cols.split(",") if c.strip()]))
    return out


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarize(plan: str) -> dict:
    by_table: dict[str, list[int]] = {}
    for table, cols in scans_of(plan):
        by_table.setdefault(table, []).append(len(cols))
    return {
        "scans": ", ".join(f"{t}×{len(v)} ({'/'.join(map(str, v))} cols)" for t, v in sorted(by_table.items())),
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "flags": ", ".join(f for f in RED_FLAGS if f in plan) or "-",
    }


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or [n for n in catalog.QUERIES if n not in MODEL_QUERIES]
    spark = build_session("local[8]", app_name="lapse-plans", shuffle_partitions=8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "1000"})
    rows = []
    landed: list = []
    materialize.observers.append(lambda what, df: landed.append((what, plan_of(df))))
    for name in names:
        landed.clear()
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        secs = time.perf_counter() - t0
        rows += [(f"{name} (lands {what})", None, summarize(plan)) for what, plan in landed]
        rows.append((name, secs, summarize(plan_of(df))))
        print(name, f"{secs:.1f}s", rows[-1][2], flush=True)
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Final AQE plans at `{sf}` (local[8]); regenerate with `python tools/plan_report.py`.",
        "Scans read source tables or tables landed by an earlier job of the same query (`landed:<name>`); the numbers are the columns each scan reads. A job that lands a table has a row of its own, above its query's, with its plan before adaptive changes. Broadcasts by size are off, so that joins show as they would at scale; explicit ones (bounded, or counted first) remain.",
        "",
        "| query | sec | scans (columns read) | shuffles | broadcasts | SMJ | BHJ | windows | red flags |",
        "| --- | --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name, secs, s in rows:
        out.append(
            f"| {name} | {'' if secs is None else f'{secs:.1f}'} | {s['scans']} | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['windows']} | {s['flags']} |"
        )
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
