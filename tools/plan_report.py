"""Summarise the physical plan of every registered query (markdown table).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Automatic broadcast is off, as it would be for tables at the target size,
so the exchanges shown are the ones a large cluster runs; each plan is the
final adaptive plan (stages reused at run time show as reused exchanges). Stream twins are
skipped (their plans are streaming plans).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata.plans import QUERIES  # noqa: E402


def summarise(plan: str) -> dict:
    if "== Final Plan ==" in plan:  # drop the initial plan printed after it
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    exchanges = re.findall(r"Exchange (hashpartitioning|SinglePartition|RoundRobinPartitioning|rangepartitioning)"
                           r"\(?([^\n]*?)(?:, \d+\))?, (?:ENSURE_REQUIREMENTS|REPARTITION_BY_COL|REPARTITION_BY_NUM|"
                           r"\[plan_id)", plan)
    kinds = {}
    for kind, args in exchanges:
        keys = re.sub(r"#\d+L?", "", args).split(", ")[:3] if kind == "hashpartitioning" else []
        label = f"hash({', '.join(k for k in keys if k and not k.isdigit())})" if keys else kind
        kinds[label] = kinds.get(label, 0) + 1
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*?Location: [^\[]*\[file:[^\]]*/(\w+)\.parquet\]"
                       r"(?:, PartitionFilters: \[[^\]]*\])?(?:, PushedFilters: \[([^\]]*)\])?", plan)
    return {
        "exchanges": kinds,
        "scans": [(t, len([c for c in cols.split(",") if c.strip()]), bool(f)) for cols, t, f in scans],
        "reused": plan.count("ReusedExchange"),
        "windows": plan.count("Window ["),
        "broadcast": plan.count("BroadcastExchange"),
        "generate": plan.count("Generate "),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}`, automatic broadcast off, final adaptive plan after running the query once. "
          "`hash(k)` = shuffle on k; `scans` = table (columns read; `pushed` when filters reach the "
          "parquet reader).\n")
    print("| query | exchanges | reused | scans | windows | generate |")
    print("|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        df = fn(spark, sf_dir)
        physical = df._jdf.queryExecution().executedPlan()
        physical.execute().count()  # run it: the adaptive plan is then final
        plan = physical.toString()
        s = summarise(plan)
        ex = "; ".join(f"{k} x{v}" if v > 1 else k for k, v in s["exchanges"].items()) or "none"
        sc = "; ".join(f"{t} ({n} cols{', pushed' if f else ''})" for t, n, f in s["scans"])
        print(f"| `{name}` | {ex} | {s['reused']} | {sc} | {s['windows']} | {s['generate']} |")
    spark.stop()


if __name__ == "__main__":
    main()
