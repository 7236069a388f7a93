"""Lookups of cells keep their tables out of broadcasts."""

import random
from collections import Counter

from pyspark.sql import functions as F

from factloom.operators import selectors as L


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_cell_tables_are_not_broadcast(spark):
    cells = spark.createDataFrame(
        [(1, 1, "string", "a", None, "text"), (2, 1, "number", "5", 5.0, "number")],
        "row long, column long, value_type string, value_text string, value_num double, kind string",
    )
    specs = spark.createDataFrame(
        [(1, 1, "text"), (2, 1, "text"), (3, 1, None)], "row long, column long, expected_kind string"
    )
    guards = spark.createDataFrame(
        [("r", "g", 1, 1, "string", "a", None), ("r", "h", 2, 1, "number", "6", 6.0), ("s", "g", 9, 1, "string", "a", None)],
        "record_id string, guard string, row long, column long, expected_type string, expected_text string, expected_num double",
    )
    found = L.lookup_cells(specs, cells, ["row", "column"], "expected_kind")
    checked = L.check_guards(guards, cells, ["row", "column"])
    for frame in (found, checked):
        assert "SortMergeJoin" in plan(frame) and "Broadcast" not in plan(frame)
    assert sorted((r["row"], r["issue"]) for r in found.collect()) == [
        (1, None), (2, "unexpected_cell_kind"), (3, "selector_did_not_match")
    ]
    assert sorted((r["record_id"], r["guard"], r["issue"]) for r in checked.collect()) == [
        ("r", "g", None), ("r", "h", "guard_mismatch"), ("s", "g", "missing_guard_cell")
    ]


def test_crowded_blocks_are_dealt_into_parts(spark):
    rng = random.Random(3)
    cells = [(rng.randint(1, 40), rng.randint(1, 12)) for _ in range(90)] + [(None, 3)]
    boxes = [(i, top := rng.randint(1, 40), top + rng.randint(-1, 9), left := rng.randint(1, 9), left + 2) for i in range(120)]
    frame = spark.createDataFrame(boxes, "no long, top_row long, bottom_row long, left_column long, right_column long")
    old, L.ROOM = L.ROOM, 8
    try:
        pairs = L.covering_regions(spark.createDataFrame(cells, "r long, c long"), frame, F.col("r"), F.col("c"), block=16)
        assert "merge" in pairs._jdf.queryExecution().logical().toString()
        found = Counter(tuple(r) for r in pairs.select("no", "r", "c").collect())
    finally:
        L.ROOM = old
    assert pairs.columns == ["r", "c", *frame.columns]
    assert found == Counter(
        (i, r, c) for i, t, b, a, z in boxes for r, c in cells if r is not None and t <= r <= b and a <= c <= z
    )
