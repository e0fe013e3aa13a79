"""Summarise the physical plan of every relational query into PLANS.md.

    python -m tests.plan_report [--sf DIR]

Per query: shuffles by partitioning key, join strategies, aggregate and window operators, and
what each parquet scan reads (columns, pushed and partition filters). The view is read from
stage tables, as a pipeline would.
"""

from __future__ import annotations

import argparse
import collections
import os
import re
import sys
import tempfile


def summarise(plan: str) -> dict:
    """Count operators, shuffles by key and scans in a physical plan tree string."""
    ops = collections.Counter()
    shuffles = collections.Counter()
    scans = []
    for line in plan.splitlines():
        m = re.match(r"^[\s:|+\-]*(\*\(\d+\) )?(\w+)", line)
        if m:
            ops[m.group(2)] += 1
        e = re.search(r"Exchange hashpartitioning\(([^)]*?), \d+\)", line)
        if e and "ReusedExchange" not in line:
            shuffles[re.sub(r"#\d+L?", "", e.group(1))] += 1
        f = re.search(r"FileScan parquet .*?\[([^\]]*)\].*?Location: \w+\(\d+ paths\)\[([^\]]*)\]"
                      r".*?PartitionFilters: (\[[^\]]*\]), PushedFilters: (\[[^\]]*\])", line)
        if f:
            scans.append((os.path.basename(f.group(2).rstrip("/")), re.sub(r"#\d+L?", "", f.group(1)),
                          re.sub(r"#\d+L?", "", f.group(3)), f.group(4)))
    return {"ops": ops, "shuffles": shuffles, "scans": scans}


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "PLANS.md"))
    a = ap.parse_args(argv)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from basketflow.plans.catalog import STAGE_VIEW_CONF
    from basketflow.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=16,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="plans-")})
    spark.conf.set(STAGE_VIEW_CONF, "true")
    qs, sql = entry.queries(), entry.oracle_sql()
    lines = ["# Physical plans (generated by `python -m tests.plan_report`)", "",
             f"Input {a.sf}, view read from stage tables, 16 shuffle partitions before AQE; each query is",
             "run first, so this is AQE's final plan. Shuffles are counted per partitioning key (a reused",
             "shuffle is listed under ReusedExchange, not counted again); joins and aggregates per operator kind.", ""]
    keep = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
            "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window",
            "WindowGroupLimit", "TakeOrderedAndProject", "MapInPandas", "ArrowEvalPython", "Expand",
            "ReusedExchange", "ShuffleQueryStage", "BroadcastQueryStage", "AQEShuffleRead")
    # Learned and corpus queries build their result in steps, so one last plan says little of them.
    for k in sorted(k for k in sql if not k.startswith(("m_", "op", "pipeline")) or k == "m_blend_scores"):
        df = qs[k](spark, a.sf)
        df.collect()  # run it, so the report shows AQE's final plan (reused stages, chosen joins)
        executed = df._jdf.queryExecution().executedPlan()
        final = executed.finalPhysicalPlan() if executed.nodeName() == "AdaptiveSparkPlan" else executed
        plan = final.toString()
        s = summarise(plan)
        lines.append(f"## {k}")
        lines.append("- shuffles: " + (", ".join(f"({key}) x{n}" for key, n in s["shuffles"].most_common()) or "none"))
        lines.append("- operators: " + ", ".join(f"{op} x{n}" for op, n in sorted(s["ops"].items()) if op in keep))
        for name, schema, part, pushed in s["scans"]:
            lines.append(f"- scan `{name}`: [{schema}]; partition filters {part}; pushed {pushed}")
        lines.append("")
    open(a.out, "w").write("\n".join(lines))
    print("wrote", a.out)


if __name__ == "__main__":
    main()
