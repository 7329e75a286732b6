"""Physical-plan summary of every listings query, as the table in PLANS.md.

    python tools/plan_report.py [sf_dir]

Per query: shuffles, broadcasts, join strategies, aggregates, windows, and
any cartesian / nested-loop join (there should be none).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin"
                          r"|Exchange SinglePartition"),
        "broadcasts": count(r"BroadcastExchange"),
        "smj": count(r"SortMergeJoin"),
        "bhj": count(r"BroadcastHashJoin"),
        "shj": count(r"ShuffledHashJoin"),
        "aggregates": count(r"(?:Hash|Sort|ObjectHash)Aggregate"),
        "windows": count(r"\bWindow \["),
        "single_partition": count(r"SinglePartition"),
        "cartesian_or_nlj": count(r"CartesianProduct|BroadcastNestedLoopJoin"),
        "python": count(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
    }


def main() -> None:
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS",
                          "--conf spark.ui.showConsoleProgress=false pyspark-shell")
    from foodgrid.session import build_session
    from foodgrid.plans import queries as Q
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("plans", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    columns = ["shuffles", "broadcasts", "smj", "bhj", "aggregates", "windows", "single_partition"]
    print("| query | shuffles | broadcasts | SMJ | BHJ | aggregates | windows | single-partition |")
    print("|" + "---|" * 8)
    bad = []
    for name, q in sorted(Q.REGISTRY.items()):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q(spark, sf_dir).explain()
        got = summarize(buf.getvalue())
        bad += [name] * bool(got["cartesian_or_nlj"] or got["python"])
        print(f"| {name} | " + " | ".join(str(got[c]) for c in columns) + " |", flush=True)
    spark.stop()
    if bad:
        print("cartesian, nested-loop or Python:", bad)


if __name__ == "__main__":
    main()
