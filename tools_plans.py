"""Write PLANS.md: the physical plan of every registered query (sf0.01)."""

import re
import sys

sys.path.insert(0, ".")
from ladle.plans.catalog import QUERIES  # noqa: E402
from ladle.session import build_session  # noqa: E402


def compact(plan: str, width: int = 230) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*\]", "Location: …", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r" Batched: \w+, DataFilters: \[.*?\], Format: Parquet, Location: …, PartitionFilters: \[\],", "",
                      line)
        out.append(line if len(line) <= width else line[:width] + " …")
    return "\n".join(out)


def main(sf_dir="/root/testdata/sf0.01"):
    spark = build_session("local[8]", shuffle_partitions=8)
    parts = ["# Physical plans of the registered queries\n",
             "Generated by `python tools_plans.py` at sf0.01 (initial adaptive plans; AQE may still switch a "
             "sort-merge join to a broadcast join, coalesce partitions or split skewed ones at run time). "
             "Look for `partial_` aggregates before each `Exchange`, `PushedFilters`, and `ReadSchema` with only "
             "the used columns.\n"]
    sc = spark.sparkContext
    for name, fn in QUERIES.items():
        sc.setJobGroup(name, name)
        df = fn(spark, sf_dir)
        eager = len(sc.statusTracker().getJobIdsForGroup(name))
        sc.setLocalProperty("spark.jobGroup.id", None)
        plan = df._jdf.queryExecution().executedPlan().toString()
        jobs = f"Jobs while the plan is built (materialized inputs, measured tables, landing files): {eager}.\n\n" if eager else ""
        parts.append(f"## {name}\n\n{jobs}```\n{compact(plan)}\n```\n")
    with open("PLANS.md", "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
