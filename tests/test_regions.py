"""Rectangles against brute force, and numbering with sparse ordinals."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import regions as G
from factloom.operators import sequence as Q


@pytest.mark.parametrize("rows,columns", [(40_000, 300), (10, 5_000), (200, 200)])
def test_regions_equal_brute_force(spark, rows, columns):
    rng = random.Random(rows)
    cells = [("s", rng.randint(1, rows), rng.randint(1, columns)) for _ in range(700)]
    cells += [("s", r, c) for r in range(1, 90) for c in range(1, 90)]  # one crowded place
    cells += [(None, 5, 5), ("t", 1, 1), ("t", None, 3), ("s", 7, 7)]
    boxes = [("s", 1, 10**9, 1, 10**9), ("t", 1, 1, 1, 1), (None, 1, 9, 1, 9), ("u", 1, 5, 1, 5)]
    boxes += [("s", 0, 5, 1, 5), ("s", 9, 5, 1, 5), ("s", None, 5, 1, 5)]
    for _ in range(150):
        top, left = rng.randint(1, rows), rng.randint(1, columns)
        boxes.append(("s", top, top + rng.randint(0, rows), left, left + rng.choice([0, 3, 70, columns])))
    boxes += [("s", 3, 8, 3, 8)] * 40  # many rectangles over one tile
    named = [(i, rng.choice(["", "a", f"r{i}", f"r{i}", f"r{i}"]), *b) for i, b in enumerate(boxes)]
    frame = spark.createDataFrame(
        named,
        "region_no int, region_id string, sheet string, top_row int, bottom_row int, left_column int, right_column int",
    )
    old, G.ROOM = G.ROOM, 16
    try:
        counts, issues, total = G.region_suite(
            frame, spark.createDataFrame(cells, "sheet string, y int, x int"), F.col("y"), F.col("x"), ["sheet"]
        )
        found = {r["region_no"]: r["covered_cells"] for r in counts.collect()}
        codes = sorted((r["region_no"] or -1, r["region_id"], r["code"]) for r in issues.collect())
        covered = total.first()["covered_cells"]
    finally:
        G.ROOM = old
    expected, every, wrong = {}, set(), []
    distinct = {c for c in cells if c[1] is not None}
    for i, name, sheet, t, b, l, r in named:
        sound = t is not None and t >= 1 and l >= 1 and b >= t and r >= l
        held = {c for c in distinct if c[0] == sheet and t <= c[1] <= b and l <= c[2] <= r} if sound else set()
        expected[i] = len(held)
        every |= held
        wrong += [(i or -1, name, "missing_region_id")] * (not name)
        if not sound or not held:
            wrong.append((i or -1, name, "region_matches_no_cells" if sound else "malformed_region_bounds"))
    wrong += [(-1, n, "duplicate_region_id") for n in {x[1] for x in named} if n and sum(x[1] == n for x in named) > 1]
    assert found == expected and covered == len(every)
    assert codes == sorted(wrong)


def test_large_rectangles_leave_few_pieces(spark):
    """A rectangle of 10^10 cells is some thousand pieces along its outline."""
    cells = spark.createDataFrame([("s", 1, 1), ("s", 200_000, 100_000)], "sheet string, r long, c long")
    frame = spark.createDataFrame([(1, "s", 5, 150_000, 9, 80_000)], "k int, sheet string, top_row long, bottom_row long, left_column long, right_column long")
    index = G.TileIndex(cells, ["sheet"], F.col("r"), F.col("c"))
    whole, border = index.decomposed(frame, "k")
    outline = 2 * (150_000 + 80_000) / G.TILE
    assert border.count() < 1.1 * outline and whole.count() < G.BASE * outline


def test_sparse_ordinals_and_many_leads(spark):
    """Every row is a block of its own, yet no window holds them all."""
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", None]), rng.randint(0, 2**61), f"f{i:05}", i % 5 or None) for i in range(3000)]
    frame = spark.createDataFrame(rows, "g string, i long, name string, v long")
    for lead in ([], ["name"]):
        found = Q.number_rows(frame, ["g"], "i", "n", lead=lead).collect()
        for g in ("hot", None):
            mine = sorted((r for r in found if r["g"] == g), key=lambda r: r["name"] if lead else r["i"])
            assert [r["n"] for r in mine] == list(range(1, len(mine) + 1))
    last, total, expected = {}, {}, {}
    for g, i, _, v in sorted(rows, key=lambda r: r[1]):
        before = total.get(g, 0)
        total[g] = before + (v or 0)
        last[g] = v if v is not None else last.get(g)
        expected[g, i] = (last[g], before)
    carried = Q.carry_forward(frame, ["g"], "i", F.col("v"), "c").collect()
    summed = Q.running_sum(frame, ["g"], "i", F.coalesce("v", F.lit(0)), "s").collect()
    assert {(r["g"], r["i"]): r["c"] for r in carried} == {k: c for k, (c, _) in expected.items()}
    assert {(r["g"], r["i"]): r["s"] for r in summed} == {k: s for k, (_, s) in expected.items()}


def test_blocks_are_folded_by_partition(spark):
    blocks = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").alias("at"), F.lit(2).cast("long").alias("n"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = Q._sum_before(blocks, ["g"], ["at"], "n", "before")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(_part") >= 1
        assert all(r["before"] == 2 * r["at"] for r in found.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_corner_sums_are_carried_over_parts_and_batches(spark):
    """Many rectangles: four corners each, whatever their outline, over many small parts."""
    rng = random.Random(4)
    sheets = ["s", "s", "s", None, "t"]
    cells = [(rng.choice(sheets), rng.randint(1, 300), rng.choice([5, rng.randint(1, 90)])) for _ in range(3000)]
    boxes = []
    for i in range(300):
        top, left = rng.randint(1, 300), rng.randint(1, 90)
        boxes.append((i, f"r{i}", rng.choice(sheets), top, top + rng.randint(0, 200), left, left + rng.randint(0, 60)))
    frame = spark.createDataFrame(
        boxes,
        "region_no int, region_id string, sheet string, top_row long, bottom_row long, left_column long, right_column long",
    )
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "23",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "17",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        held = spark.createDataFrame(cells, "sheet string, y int, x int")
        counts, _, total = G.region_suite(frame, held, F.col("y"), F.col("x"), ["sheet"])
        assert "sequence(" not in counts._jdf.queryExecution().optimizedPlan().toString()
        found, covered = {r["region_no"]: r["covered_cells"] for r in counts.collect()}, total.first()["covered_cells"]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    inside = {
        i: {c for c in set(cells) if c[0] == s and t <= c[1] <= b and l <= c[2] <= r} for i, _, s, t, b, l, r in boxes
    }
    assert found == {i: len(c) for i, c in inside.items()} and covered == len(set().union(*inside.values()))
