"""Summarise the physical plan of every registered query.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts shuffle exchanges, broadcast exchanges and join operators in the
final (adaptive) plan after executing each query with the noop sink.
"""

from __future__ import annotations

import re
import sys


GUIDE = """How to read it:

* **Hash shuffles.** Every candidate-based query has one hash shuffle for the candidate aggregate
  (partial aggregate before it). Breach-based queries add the fixture corpus (strings counted, then
  orders per customer) and one exchange per side of the breach join, unless AQE broadcasts a side.
* **Broadcasts.** Explicit ones are of bounded tables only: per-class fractions (one row per class), the
  exact-sampling bucket table (at most classes x 4096), `nation` (25 rows), and the candidates of
  `breach_match_broadcast` after their row count. All others are AQE's, from measured sizes.
* No query has a Cartesian product or Python evaluation.
"""


def main():
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    from keysieve.plans.registry import ORACLE, QUERIES, load_all
    load_all()
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py {sf_dir}`. It executes each query (noop sink) and reads the")
    print("final adaptive plan. It counts hash and round-robin shuffles, broadcast exchanges (with their")
    print("build-side operator), join operators, and Python evaluation. Queries that stage an input or")
    print("write files show only the plan of the returned frame.\n")
    print(GUIDE)
    print("| query | oracle | hash shuffles | round-robin | broadcasts | joins | python |")
    print("|---|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        hashx = len(re.findall(r"Exchange hashpartitioning", plan))
        rr = len(re.findall(r"Exchange RoundRobinPartitioning", plan))
        bc = len(re.findall(r"BroadcastExchange", plan))
        joins = sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                                      r"BroadcastNestedLoopJoin|CartesianProduct)", plan)))
        py = "yes" if re.search(r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)", plan) else "no"
        print(f"| `{name}` | {'D' if name in ORACLE else 'R'} | {hashx} | {rr} | {bc} | "
              f"{', '.join(joins) or '—'} | {py} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
