"""Cells and rectangles met by their corners: work that follows their number only.

A rectangle has four signed corners.  The cells before each corner, in rows and in
columns, add up to the cells inside the rectangle; the signs of the corners before
a cell add up to the number of rectangles over it.  Both are sums over what comes
before in two directions, taken together: rows are cut into digits of base
``BASE``, and two places differ first in one digit, so each place goes once to
each digit, under the digits above it.  Under the same higher digits the places
are sorted by column into range partitions, where running totals per digit are
kept; one row per partition carries them on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.sequence import join_on
from factloom.session import materialise, store

BASE = 16

_GROUP = ["sheet", "level", "above"]
_RUNNING = (
    "part int, y bigint, x bigint, sheet string, digit int, value bigint, opens boolean, "
    "first string, last string, cells array<bigint>, signs array<bigint>"
)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of earlier rows with smaller digits, per group of sorted rows.

    A last row has the part's first and last group and the totals of the latter.
    """
    part = TaskContext.get().partitionId()
    names = [f.split()[0] for f in _RUNNING.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds["array<bigint>"] = pa.list_(pa.int64())
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _RUNNING.split(", ")])
    first = last = None
    held = np.zeros((2, BASE), np.int64)

    def made(n, **columns):
        whole = [columns.get(c, pa.nulls(n, schema.field(c).type)) for c in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(a, schema.field(c).type) if not isinstance(a, pa.Array) else a for a, c in zip(whole, names)],
            schema=schema,
        )

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        key = lambda i: "|".join(str(column[c][i].as_py()) for c in ("level", "above", "sheet"))
        differs = np.zeros(n, bool)
        for c in _GROUP:
            differs[1:] |= pc.not_equal(column[c][1:], column[c][:-1]).to_numpy(zero_copy_only=False)
        differs[0] = key(0) != last
        if first is None:
            first, differs[0] = key(0), True
            opens = True
        elif differs[0]:
            opens = False
        starts = np.flatnonzero(differs)
        segment = np.cumsum(differs)
        y, x = column["y"].to_numpy(), column["x"].to_numpy()
        digit = column["digit"].to_numpy()
        at = np.arange(n)
        corner = y % 2 == 0
        before = np.zeros((2, n), np.int64)
        ends = np.zeros((2, BASE), np.int64)
        for i, name in enumerate(("n", "w")):
            seen = np.zeros((n + 1, BASE), np.int64)
            seen[at + 1, digit] = column[name].to_numpy()
            np.cumsum(seen, axis=0, out=seen)
            base = np.vstack([-held[i], seen[starts]])
            ends[i] = seen[n] - base[segment[-1]]
            smaller = np.cumsum(seen[:n] - base[segment], axis=1)
            before[i] = np.where(digit > 0, smaller[at, digit - 1], 0)
        held, last = ends, key(n - 1)
        value = np.where(corner, before[0], before[1])
        # The rows of the part's first group go on with what earlier parts carry.
        inside = (segment <= 1) & opens if differs[0] else (segment == 0) & opens
        opens = bool(inside[-1])
        keep = np.flatnonzero((value != 0) | inside)
        if len(keep):
            yield made(
                len(keep),
                part=np.full(len(keep), part, np.int32),
                y=y[keep],
                x=x[keep],
                sheet=column["sheet"].take(pa.array(keep)),
                digit=digit[keep],
                value=value[keep],
                opens=inside[keep],
            )
    if first is not None:
        yield made(1, part=[part], first=[first], last=[last], cells=[held[0].tolist()], signs=[held[1].tolist()])


def _sums(places: DataFrame) -> DataFrame:
    """``sheet, y, x, value``: for each place the sum over places with smaller y and x.

    ``places``: distinct ``sheet, y, x`` with ``n`` and ``w`` and the number of
    ``levels``.  An even y takes the sum of ``n``, an odd one that of ``w``; sums of
    0 may be left out.
    """
    power = lambda k: F.pow(F.lit(float(BASE)), k).cast("bigint")
    level = F.explode(F.sequence(F.lit(0), F.col("levels") - 1))
    dealt = places.withColumn("level", level).select(
        "sheet",
        "level",
        F.call_function("div", F.col("y"), power(F.col("level") + 1)).alias("above"),
        (F.call_function("div", F.col("y"), power(F.col("level"))) % BASE).cast("int").alias("digit"),
        *["x", "y", "n", "w"],
    )
    order = [*_GROUP, "x", "y"]
    sorted_rows = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    found = store(sorted_rows.mapInArrow(_run, _RUNNING), "sweep")
    # One row per partition from here to the join.
    parts = found.filter("first is not null").select("part", "first", "last", "cells", "signs")
    earlier = parts.select(F.col("part").alias("_q"), F.col("last").alias("first"), "cells", "signs")
    added = lambda name, i: F.sum(F.element_at(name, i + 1)).alias(f"{name}_{i}")
    carried = (
        parts.select("part", "first")
        .join(earlier, "first")
        .filter("_q < part")
        .groupBy("part")
        .agg(*[added(name, i) for name in ("cells", "signs") for i in range(BASE)])
    )
    smaller = lambda name: F.array(
        *[sum((F.col(f"{name}_{j}") for j in range(i)), F.lit(0).cast("bigint")) for i in range(BASE)]
    )
    carried = carried.select("part", smaller("cells").alias("_n"), smaller("signs").alias("_w"))
    rows = found.filter("first is null").drop("first", "last", "cells", "signs")
    inner = rows.filter("not opens").select("sheet", "y", "x", "value")
    carry = F.get(F.when(F.col("y") % 2 == 0, F.col("_n")).otherwise(F.col("_w")), F.col("digit"))
    opening = (
        rows.filter("opens")
        .join(carried, "part", "left")
        .select("sheet", "y", "x", (F.col("value") + F.coalesce(carry, F.lit(0))).alias("value"))
    )
    return inner.unionByName(opening).groupBy("sheet", "y", "x").agg(F.sum("value").alias("value"))


def sweep(
    boxes: DataFrame, cells: DataFrame, row: Column, column: Column, sheet: Sequence[str], key: str
) -> tuple[DataFrame, DataFrame]:
    """``key, covered_cells`` of every box that holds a cell, and one row
    ``covered_cells``: distinct cells that any box holds.

    ``boxes``: a unique ``key``, the sheet columns and ``top_row, bottom_row,
    left_column, right_column`` in order; ``cells``: may repeat.
    """
    name = F.to_json(F.struct(F.lit(0).alias("_"), *sheet)).alias("sheet")
    held = cells.select(name, row.cast("bigint").alias("r"), column.cast("bigint").alias("c")).filter(
        "r is not null and c is not null"
    )
    bound = lambda f, c, out: f(c).alias(out)
    outline = held.groupBy("sheet").agg(
        bound(F.min, "r", "_ar"), bound(F.max, "r", "_zr"), bound(F.min, "c", "_ac"), bound(F.max, "c", "_zc")
    )
    cut = join_on(boxes.select(key, name, "top_row", "bottom_row", "left_column", "right_column"), outline, ["sheet"], "inner")
    cut = cut.select(
        key,
        "sheet",
        F.greatest(F.col("top_row"), "_ar").cast("bigint").alias("r1"),
        F.least(F.col("bottom_row"), "_zr").cast("bigint").alias("r2"),
        F.greatest(F.col("left_column"), "_ac").cast("bigint").alias("c1"),
        F.least(F.col("right_column"), "_zc").cast("bigint").alias("c2"),
    ).filter("r1 <= r2 and c1 <= c2")
    cut = materialise(cut, "boxes")
    # Cells outside the outline of their sheet's boxes are in no box.
    reach = cut.groupBy("sheet").agg(
        bound(F.min, "r1", "_ar"), bound(F.max, "r2", "_zr"), bound(F.min, "c1", "_ac"), bound(F.max, "c2", "_zc")
    )
    height = (F.col("_zr") - F.col("_ar") + 2) * 2
    digits = F.ceil(F.log(float(BASE), height.cast("double")) + 1e-9)
    reach = reach.withColumn("levels", F.greatest(digits, F.lit(1)).cast("int"))
    # Rows and columns are doubled; cells are odd, so a corner comes before its cell.
    inside = (
        join_on(held, reach, ["sheet"], "inner")
        .filter("r between _ar and _zr and c between _ac and _zc")
        .select(
            "sheet",
            ((F.col("r") - F.col("_ar")) * 2 + 1).alias("y"),
            (F.col("c") * 2 + 1).alias("x"),
            "levels",
        )
        .distinct()
    )
    corner = lambda r, c, sign: F.struct(
        ((F.col(r[0]) + r[1] - F.col("_ar")) * 2).alias("y"),
        ((F.col(c[0]) + c[1]) * 2).alias("x"),
        F.lit(sign).cast("bigint").alias("sign"),
    )
    corners = join_on(cut, reach, ["sheet"], "inner").select(
        key,
        "sheet",
        "levels",
        F.inline(
            F.array(
                corner(("r1", 0), ("c1", 0), 1),
                corner(("r1", 0), ("c2", 1), -1),
                corner(("r2", 1), ("c1", 0), -1),
                corner(("r2", 1), ("c2", 1), 1),
            )
        ),
    )
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    signed = corners.groupBy("sheet", "y", "x", "levels").agg(F.sum("sign").alias("w"))
    places = inside.withColumns({"n": one, "w": zero}).unionByName(signed.withColumn("n", zero))
    values = materialise(_sums(materialise(places, "places")), "sums")
    counts = (
        corners.join(values, ["sheet", "y", "x"])
        .groupBy(key)
        .agg(F.sum(F.col("sign") * F.col("value")).alias("covered_cells"))
        .filter("covered_cells > 0")
    )
    return counts, values.filter("y % 2 = 1 and value > 0").agg(F.count(F.lit(1)).alias("covered_cells"))
