"""Block-wise sequence operators against brute force, with tiny blocks."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.functions import canonical as C
from factloom.functions import keys as K
from factloom.operators import sequence as Q


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    # One group holds most rows, one has a null name, ordinals have gaps.
    data = []
    for i in random.sample(range(5000), 900):
        group = random.choices(["hot", "b", None], [8, 1, 1])[0]
        mark = random.choice([None, None, None, i % 7])
        data.append((group, i, mark))
    return data


SCHEMA = "g string, i long, v long"


def by_group(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(row[0], []).append(row)
    return groups


def test_number_rows(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = Q.number_rows(frame, ["g"], "i", "n", width=64, start=2).collect()
    expected = {
        (r[0], r[1]): n
        for members in by_group(rows).values()
        for n, r in enumerate(members, 2)
    }
    assert {(r["g"], r["i"]): r["n"] for r in found} == expected


def test_number_rows_global_with_lead(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("k", F.col("i") % 3)
    found = Q.number_rows(frame, [], "i", "n", lead=["k"], width=16).collect()
    ordered = sorted(found, key=lambda r: (r["k"], r["i"]))
    assert [r["n"] for r in ordered] == list(range(1, len(rows) + 1))


def test_carry_forward(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    found = Q.carry_forward(frame, ["g"], "i", F.col("v"), "c", width=32).collect()
    expected = {}
    for members in by_group(rows).values():
        last = None
        for g, i, v in members:
            last = v if v is not None else last
            expected[(g, i)] = last
    assert {(r["g"], r["i"]): r["c"] for r in found} == expected


def test_running_sum(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    value = F.coalesce("v", F.lit(0))
    found = Q.running_sum(frame, ["g"], "i", value, "s", width=32).collect()
    expected = {}
    for members in by_group(rows).values():
        total = 0
        for g, i, v in members:
            expected[(g, i)] = total
            total += v or 0
    assert {(r["g"], r["i"]): r["s"] for r in found} == expected


def test_sections_run_to_the_end_without_end_marker(spark):
    rows = [("a", 1, 0), ("a", 2, 1), ("a", 3, 0), ("b", 1, 2), ("b", 2, 1), ("b", 3, 2)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = Q.sections(frame, ["g"], "i", F.col("v") == 1, F.col("v") == 2)
    assert sorted((r["g"], r["i"]) for r in found.collect()) == [
        ("a", 2),
        ("a", 3),
        ("b", 2),
    ]


def test_first_wins_ignores_partitioning(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    results = [
        sorted(Q.first_wins(f, ["g"], ["i"]).collect(), key=repr)
        for f in (frame, frame.repartition(11), frame.orderBy(F.desc("i")))
    ]
    assert results[0] == results[1] == results[2]


def test_dataset_digest_is_independent_of_order(spark, rows):
    frame = spark.createDataFrame(rows + rows[:50], SCHEMA)
    text = C.record({"g": F.col("g"), "i": F.col("i"), "v": F.col("v")})
    digests = {
        K.dataset_digest(f, text).first()["digest"]
        for f in (frame, frame.repartition(5), frame.orderBy("v"))
    }
    assert len(digests) == 1
    once = spark.createDataFrame(rows, SCHEMA)
    assert K.dataset_digest(once, text).first()["digest"] not in digests


def test_canonical_text_is_unambiguous(spark):
    frame = spark.createDataFrame([("a|y=b", None), ("a", "b")], "x string, y string")
    texts = frame.select(C.record({"x": F.col("x"), "y": F.col("y")})).collect()
    assert texts[0][0] != texts[1][0]
