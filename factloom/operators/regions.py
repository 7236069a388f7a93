"""Rectangles over cells, counted through an index of tiles on several levels.

A tile of level 1 is ``TILE`` rows by ``TILE`` columns; a tile of each further
level is ``BASE`` by ``BASE`` tiles of the level before.  A rectangle is cut into
the coarsest tiles that lie inside it, whose cells are counted once for all
rectangles, and a border thinner than a tile, whose cells are compared one by
one.  So the work of a rectangle follows its outline, not its area, and pairs of
cells and rectangles exist only along borders, inside the join that counts them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.dominance import sweep
from factloom.operators.sequence import join_on

TILE, BASE, LEVELS = 64, 16, 5
#: Border strips of one tile that meet its cells (at most TILE * TILE) in one task.
ROOM = 4096

_STRIP = "array<struct<r1:bigint,r2:bigint,c1:bigint,c2:bigint>>"


def _inner(unit: int) -> list[Column]:
    """The rectangle of whole units inside rows r1..r2 and columns c1..c2."""
    first = lambda x: F.ceil(F.col(x) / unit)
    last = lambda x: F.floor((F.col(x) + 1) / unit) - 1
    return [first("r1").alias("i1"), last("r2").alias("i2"), first("c1").alias("j1"), last("c2").alias("j2")]


def _peeled(boxes: DataFrame, keep: Sequence[str], unit: int) -> tuple[DataFrame, DataFrame]:
    """Strips around the whole units of each box, and those units as boxes."""
    cut = boxes.select(*keep, "r1", "r2", "c1", "c2", *_inner(unit)).withColumn(
        "_has", (F.col("i1") <= F.col("i2")) & (F.col("j1") <= F.col("j2"))
    )
    top, bottom = F.col("i1") * unit, (F.col("i2") + 1) * unit - 1
    left, right = F.col("j1") * unit, (F.col("j2") + 1) * unit - 1
    box = lambda r1, r2, c1, c2: F.struct(
        r1.alias("r1"), r2.alias("r2"), c1.alias("c1"), c2.alias("c2")
    )
    r1, r2, c1, c2 = (F.col(x) for x in ("r1", "r2", "c1", "c2"))
    around = F.array(
        box(r1, top - 1, c1, c2),
        box(bottom + 1, r2, c1, c2),
        box(top, bottom, c1, left - 1),
        box(top, bottom, right + 1, c2),
    ).cast(_STRIP)
    strips = F.when(F.col("_has"), around).otherwise(F.array(box(r1, r2, c1, c2)).cast(_STRIP))
    outer = cut.select(*keep, F.inline(strips)).filter("r1 <= r2 and c1 <= c2")
    inner = cut.filter("_has").select(
        *keep, *[F.col(a).alias(b) for a, b in (("i1", "r1"), ("i2", "r2"), ("j1", "c1"), ("j2", "c2"))]
    )
    return outer, inner


def _tiles(strips: DataFrame, unit: int) -> DataFrame:
    """One row per strip and tile (``tr, tc``) of ``unit`` rows and columns it touches."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / unit), F.floor(F.col(b) / unit))
    return strips.withColumn("tr", F.explode(span("r1", "r2"))).withColumn(
        "tc", F.explode(span("c1", "c2"))
    )


class TileIndex:
    """Distinct cells (``sheet, r, c``) and how many of them each tile has."""

    def __init__(self, cells: DataFrame, sheet: Sequence[str], row: Column, column: Column):
        self.sheet = list(sheet)
        place = [row.cast("bigint").alias("r"), column.cast("bigint").alias("c")]
        self.cells = (
            cells.select(*self.sheet, *place).filter("r is not null and c is not null").distinct()
        )
        tile = lambda x: F.floor(F.col(x) / TILE)
        level = self.cells.groupBy(*self.sheet, tile("r").alias("tr"), tile("c").alias("tc"))
        self.levels = [level.agg(F.count(F.lit(1)).alias("n"))]
        up = lambda x: F.floor(F.col(x) / BASE).alias(x)
        for _ in range(LEVELS - 1):
            coarser = self.levels[-1].groupBy(*self.sheet, up("tr"), up("tc"))
            self.levels.append(coarser.agg(F.sum("n").alias("n")))

    def counts(self) -> DataFrame:
        """``sheet, level, tr, tc, n`` of all levels."""
        marked = [t.withColumn("level", F.lit(k)) for k, t in enumerate(self.levels, 1)]
        return reduce(DataFrame.unionByName, marked)

    def clipped(self, regions: DataFrame, key: str) -> DataFrame:
        """Rectangles cut to the outline of their sheet's cells; empty ones go."""
        outline = self.cells.groupBy(*self.sheet).agg(
            *[f(x).alias(f"_{n}{x}") for x in "rc" for n, f in (("a", F.min), ("z", F.max))]
        )
        met = join_on(regions, outline, self.sheet, "inner")
        return met.select(
            key,
            *self.sheet,
            F.greatest(F.col("top_row"), F.col("_ar")).cast("bigint").alias("r1"),
            F.least(F.col("bottom_row"), F.col("_zr")).cast("bigint").alias("r2"),
            F.greatest(F.col("left_column"), F.col("_ac")).cast("bigint").alias("c1"),
            F.least(F.col("right_column"), F.col("_zc")).cast("bigint").alias("c2"),
        ).filter("r1 <= r2 and c1 <= c2")

    def decomposed(self, regions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """Whole tiles (key, sheet, level, tr, tc) and border strips per tile of
        level 1 (key, sheet, tr, tc, r1, r2, c1, c2) of each rectangle."""
        keep = [key, *self.sheet]
        border, boxes = _peeled(self.clipped(regions, key), keep, TILE)
        whole = []
        for level in range(1, LEVELS + 1):
            if level < LEVELS:
                strips, boxes = _peeled(boxes, keep, BASE)
            else:
                strips = boxes
            whole.append(_tiles(strips, 1).select(*keep, F.lit(level).alias("level"), "tr", "tc"))
        return reduce(DataFrame.unionByName, whole), _tiles(border, TILE)

    def border_pairs(self, border: DataFrame) -> DataFrame:
        """Cells and border strips that hold them.

        A tile with many strips is dealt over salts, and so are its few cells.
        """
        tile = [*self.sheet, "tr", "tc"]
        load = border.groupBy(*tile).agg(F.ceil(F.count(F.lit(1)) / ROOM).alias("_salts"))
        dealt = join_on(border, load, tile, "inner").withColumn(
            "_salt", F.pmod(F.xxhash64("r1", "r2", "c1", "c2", *border.columns[:1]), F.col("_salts"))
        )
        at = lambda x: F.floor(F.col(x) / TILE)
        placed = self.cells.withColumns({"tr": at("r"), "tc": at("c")})
        spread = join_on(placed, load, tile, "inner").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1))
        )
        pairs = join_on(dealt.drop("_salts"), spread.drop("_salts"), [*tile, "_salt"], "inner")
        return pairs.filter(
            F.col("r").between(F.col("r1"), F.col("r2")) & F.col("c").between(F.col("c1"), F.col("c2"))
        )

    def region_counts(self, regions: DataFrame, key: str) -> DataFrame:
        """``key, covered_cells`` of every rectangle that holds a cell.

        ``regions``: a unique ``key``, the sheet columns and ``top_row,
        bottom_row, left_column, right_column``.
        """
        whole, border = self.decomposed(regions, key)
        tile = [*self.sheet, "level", "tr", "tc"]
        inside = join_on(whole, self.counts(), tile, "inner").groupBy(key).agg(F.sum("n").alias("n"))
        edge = self.border_pairs(border).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return inside.unionByName(edge).groupBy(key).agg(F.sum("n").alias("covered_cells"))

    def covered_total(self, regions: DataFrame, key: str) -> DataFrame:
        """One row ``covered_cells``: distinct cells that any rectangle holds."""
        whole, border = self.decomposed(regions, key)
        tile = [*self.sheet, "tr", "tc"]
        ancestors = [
            F.struct(
                F.lit(k).alias("level"),
                F.floor(F.col("tr") / BASE ** (k - 1)).alias("ar"),
                F.floor(F.col("tc") / BASE ** (k - 1)).alias("ac"),
            )
            for k in range(1, LEVELS + 1)
        ]
        reach = self.levels[0].select(*tile, "n", F.inline(F.array(*ancestors)))
        taken = whole.select(
            *self.sheet, "level", F.col("tr").alias("ar"), F.col("tc").alias("ac")
        ).distinct()
        full = (
            join_on(reach, taken, [*self.sheet, "level", "ar", "ac"], "inner")
            .groupBy(*tile)
            .agg(F.max("n").alias("n"))
        )
        edge = join_on(
            self.border_pairs(border).select(*tile, "r", "c").distinct(),
            full.select(*tile, F.lit(True).alias("_full")),
            tile,
        ).filter("_full is null")
        parts = full.select("n").unionByName(edge.select(F.lit(1).cast("bigint").alias("n")))
        return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("covered_cells"))


def region_suite(
    regions: DataFrame,
    cells: DataFrame,
    row: Column,
    column: Column,
    sheet: Sequence[str] = (),
    key: str = "region_no",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts per rectangle (``key, region_id, covered_cells``), issue rows
    (``key, region_id, code``) and the number of distinct covered cells.

    Rectangles with bounds below 1 or out of order cover nothing.  An id that is
    blank is an issue of its row, a repeated one an issue of the id.
    """
    sound = (
        (F.col("top_row") >= 1)
        & (F.col("left_column") >= 1)
        & (F.col("bottom_row") >= F.col("top_row"))
        & (F.col("right_column") >= F.col("left_column"))
    )
    sound = F.coalesce(sound, F.lit(False))
    found, total = sweep(regions.filter(sound), cells, row, column, sheet, key)
    counts = regions.join(found, key, "left").withColumn(
        "covered_cells", F.coalesce("covered_cells", F.lit(0).cast("bigint"))
    )
    codes = F.array_compact(
        F.array(
            F.when(F.coalesce(F.trim("region_id"), F.lit("")) == "", "missing_region_id"),
            F.when(~sound, "malformed_region_bounds").when(
                F.col("covered_cells") == 0, "region_matches_no_cells"
            ),
        )
    )
    own = counts.select(key, "region_id", F.explode(codes).alias("code"))
    copies = regions.filter("region_id != ''").groupBy("region_id").agg(F.count(F.lit(1)).alias("_n"))
    repeated = copies.filter("_n > 1").select(
        F.lit(None).cast(regions.schema[key].dataType).alias(key),
        "region_id",
        F.lit("duplicate_region_id").alias("code"),
    )
    return counts.select(key, "region_id", "covered_cells"), own.unionByName(repeated), total
