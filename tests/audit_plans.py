"""Print queries whose physical plan has a nested loop or a one-task window."""

import os
import re
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

SUSPECT = {
    "nested loop": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "one-task exchange": r"Exchange SinglePartition",
    "unpartitioned window": r"Window \[.*?\], \[[^\]]*ASC",
    "python": r"MapInPandas|ArrowEvalPython|BatchEvalPython",
}


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    pattern = sys.argv[2] if len(sys.argv) > 2 else ""
    spark = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    for name, run in entry.queries().items():
        if not re.search(pattern, name):
            continue
        frame = run(spark, folder)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        hits = {k: len(re.findall(p, plan)) for k, p in SUSPECT.items()}
        hits = {k: n for k, n in hits.items() if n}
        if hits:
            print(name, hits)


if __name__ == "__main__":
    main()
