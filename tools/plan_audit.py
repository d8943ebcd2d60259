"""Scan the executed physical plan of every registered query for patterns
that do not scale: single-partition exchanges, nested-loop / cartesian
joins, and list what is broadcast and where Python runs.

usage: python tools/plan_audit.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "single_partition_exchange": r"Exchange SinglePartition",
    "nested_loop_join": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "broadcast": r"BroadcastExchange",
    "python_udf": r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas)",
    "window": r"\bWindow \[",
}


def problems(plan: str) -> list[str]:
    """Plan lines that would not scale: a single-partition exchange fed by
    data (not by a partial aggregate or a table bounded by construction), or
    a nested-loop / cartesian join whose build side is not one row."""
    out = []
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(PATTERNS["single_partition_exchange"], line):
            child = lines[i + 1] if i + 1 < len(lines) else ""
            ok = re.search(r"(HashAggregate|ObjectHashAggregate|SortAggregate).*partial_", child)
            bounded = re.search(r"keys=\[(_pos_pid|Class|model|label|_c)#", child) or "feature" in child
            if not (ok or bounded):
                out.append(child.strip())
        if re.search(r"BroadcastNestedLoopJoin|CartesianProduct", line):
            j = next((k for k in range(i + 1, len(lines)) if "IdentityBroadcastMode" in lines[k]), None)
            build = " ".join(lines[j:j + 4]) if j is not None else ""
            if not re.search(r"HashAggregate\(keys=\[\]|LocalTableScan|Scan ExistingRDD|LogicalRDD", build):
                out.append(line.strip())
    return out


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from txnlens.plans.catalog import load_all
    from txnlens.session import get_spark

    spark = get_spark(master="local[8]", shuffle_partitions=8)
    reg = load_all()
    for name in names or sorted(reg):
        df = reg[name].fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        flags = " ".join(f"{k}={v}" for k, v in hits.items() if v)
        print(f"{name}: {flags}")
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if re.search(PATTERNS["single_partition_exchange"], line):
                child = lines[i + 1].strip() if i + 1 < len(lines) else ""
                # a partial aggregate under it: one row per partition crosses;
                # keys bounded by construction: range partitions, classes,
                # models, features
                ok = re.search(r"(HashAggregate|ObjectHashAggregate|SortAggregate).*partial_", child)
                bounded = re.search(r"keys=\[(_pos_pid|Class|model|label|_c)#", child) or "feature" in child
                tag = "ok     " if ok else ("bounded" if bounded else "CHECK  ")
                print("    ", tag, "SinglePartition <-", re.sub(r"#\d+L?", "", child)[:140])
            if re.search(r"BroadcastNestedLoopJoin|CartesianProduct", line):
                # the build side of a cross join is the IdentityBroadcastMode exchange
                j = next((k for k in range(i + 1, len(lines)) if "IdentityBroadcastMode" in lines[k]), None)
                build = " ".join(lines[j:j + 4]) if j is not None else ""
                one_row = re.search(r"HashAggregate\(keys=\[\]|LocalTableScan|Scan ExistingRDD|LogicalRDD", build)
                print("    ", "one-row" if one_row else "CHECK  ", line.strip()[:100])
    spark.stop()


if __name__ == "__main__":
    main()
