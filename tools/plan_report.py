"""Summarise the physical plan of every registered query of the library.

Usage: python tools/plan_report.py [sf_dir] [--no-broadcast] [key ...]

For each key: shuffles (Exchange), join strategies, aggregation phases and
the columns each Parquet scan reads.  ``--no-broadcast`` sets
``spark.sql.autoBroadcastJoinThreshold=-1`` to show the plan a cluster gets
when the dimension tables are too large to broadcast.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from usagelake.session import build_session  # noqa: E402

OPS = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate",
       "SortAggregate", "Window", "Generate", "BatchEvalPython", "ArrowEvalPython")


def explain_text(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summary(text: str) -> dict:
    tree = text.split("\n\n")[0]
    counts = {}
    for op in OPS:
        n = len(re.findall(rf"(?:^|[+\-:] ){op}\b(?! \[)", tree, re.M))
        if n:
            counts[op] = n
    scans = re.findall(r"Location: InMemoryFileIndex \[file:[^\]]*/([a-z_]+)\.parquet\]"
                       r"(?:\nPushedFilters: \[([^\]]*)\])?\nReadSchema: struct<([^>]*)>", text)
    return {"ops": counts, "scans": [(t, f, len(s.split(","))) for t, f, s in scans]}


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:]
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if "--no-broadcast" in sys.argv else {}
    spark = build_session("local[4]", 8, extra=extra)
    from usagelake.plans.catalog import QUERIES
    print(f"# plans at {sf_dir} broadcast={'off' if extra else 'size-checked'}")
    for k, fn in QUERIES.items():
        if keys and k not in keys:
            continue
        s = summary(explain_text(fn(spark, sf_dir)))
        ops = ", ".join(f"{o}={n}" for o, n in s["ops"].items())
        scans = "; ".join(f"{t}[{n} cols]" for t, _, n in s["scans"])
        print(f"{k:28s} {ops} | scans: {scans}")


if __name__ == "__main__":
    main()
