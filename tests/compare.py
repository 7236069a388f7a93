"""Run registered queries against their SQL twins: python tests/compare.py [sf] [pattern]."""

import os
import re
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    pattern = sys.argv[2] if len(sys.argv) > 2 else ""
    folder = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    oracles, bad = entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if not re.search(pattern, name):
            continue
        began = time.time()
        try:
            frame = run(spark, folder)
            types = {f.name: f.dataType.simpleString() for f in frame.schema}
            left = frame.toArrow()
        except Exception:
            print(f"FAIL {name}: spark\n{traceback.format_exc()[-450:]}")
            bad.append(name)
            continue
        spent = time.time() - began
        if name not in oracles:
            print(f"rows {name}: {left.num_rows} rows {spent:.1f}s")
            continue
        try:
            relation = duck.sql(oracles[name])
            expected = {
                column: TYPES.get(str(kind), str(kind))
                for column, kind in zip(relation.columns, relation.types)
            }
            right = relation.to_arrow_table()
        except Exception as error:
            print(f"FAIL {name}: sql {str(error)[:900]}")
            bad.append(name)
            continue
        columns = sorted(types)
        problems = []
        if types != expected:
            problems.append(f"types {types} != {expected}")
        if left.num_rows != right.num_rows:
            problems.append(f"rows {left.num_rows} != {right.num_rows}")
        if sorted(expected) == columns:
            pick = lambda t: sorted(
                zip(*[t.column(c).to_pylist() for c in columns]), key=repr
            )
            mine, theirs = pick(left), pick(right)
            if mine != theirs:
                first = [pair for pair in zip(mine, theirs) if pair[0] != pair[1]][:2]
                problems.append(f"values {columns} {first}")
        if problems:
            bad.append(name)
            print(f"FAIL {name}: {'; '.join(p[:1200] for p in problems)}")
        else:
            empty = " EMPTY" if left.num_rows == 0 else ""
            print(f"ok   {name}: {left.num_rows} rows {spent:.1f}s{empty}")
    print("BAD", len(bad), bad)


if __name__ == "__main__":
    main()
