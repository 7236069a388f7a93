"""A stored table keeps its version until a load is committed."""

import pytest
from pyspark.sql import functions as F

from factloom.sources.snapshots import Snapshots


def rows(table):
    return {r["k"]: r["v"] for r in table.read().collect()}


def test_loads_rewrite_touched_buckets_only(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), ["k"], 8)
    assert table.read() is None and table.version() == 0
    first = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert table.load(first) == 1 and rows(table) == {k: "a" for k in range(100)}
    second = spark.createDataFrame([(3, "b"), (200, "b"), (None, "n")], "k long, v string")
    assert table.load(second) == 2
    expected = {k: "a" for k in range(100)} | {3: "b", 200: "b", None: "n"}
    assert rows(table) == expected
    versions = table.manifest()
    assert set(versions.values()) == {1, 2} and sum(v == 2 for v in versions.values()) <= 3
    third = spark.createDataFrame([(None, "m")], "k long, v string")
    table.load(third)
    assert rows(table) == expected | {None: "m"}
    assert table.load(first.limit(0)) == 4 and rows(table) == expected | {None: "m"}


def test_a_failed_load_leaves_the_old_version(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), ["k"], 4)
    table.load(spark.createDataFrame([(1, "a"), (2, "a")], "k long, v string"))
    broken = spark.range(50).select(
        F.col("id").alias("k"),
        F.when(F.col("id") == 40, F.raise_error(F.lit("no"))).otherwise("b").alias("v"),
    )
    with pytest.raises(Exception, match="no"):
        table.load(broken)
    with pytest.raises(ValueError, match="repeat"):
        table.load(spark.createDataFrame([(2, "x"), (2, "y")], "k long, v string"))
    assert rows(table) == {1: "a", 2: "a"} and table.version() == 1
    table.load(spark.createDataFrame([(2, "c")], "k long, v string"))
    assert rows(table) == {1: "a", 2: "c"}
