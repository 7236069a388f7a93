"""Order-dependent operators that never put a whole group in one task.

A group (a source, a user, a sheet) may hold a third of all rows, so a plain
window over the group is not used.  Rows are cut into blocks of ``width``
consecutive ordinals; work inside a block is a window over (group, block), and
only one summary row per block is carried across blocks.  Where ordinals are
sparse or leads are many there are nearly as many blocks as rows, so blocks are
not carried in one task either: they are sorted into range partitions, folded
inside each, and one row per partition is folded across.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factloom.session import store

WIDTH = 65_536


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"):
    """Join on equal or both-null keys, keeping one copy of the keys."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    joined = left.join(renamed, test, how)
    return joined.drop(*[f"_r_{key}" for key in keys])


def fold_before(
    blocks: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    fold: Callable[[Column], Column],
    total: Callable[[Column, Column], Column],
    merge: Callable[[Column, Column], Column],
) -> DataFrame:
    """``group``, ``order`` and ``out``: ``value`` folded over the earlier blocks.

    ``fold`` is an aggregate over ordered rows, ``total`` the same without an
    order (it is given the value and a struct to order by), ``merge`` puts the
    fold of earlier partitions before that inside the own one.  The sorted blocks
    are written once, so both uses see the same partitions.
    """
    ranged = blocks.select(*group, *order, value).repartitionByRange(*group, *order)
    placed = store(ranged.withColumn("_part", F.spark_partition_id()), "blocks")
    sort = [F.col(name).asc_nulls_first() for name in order]
    own = W.partitionBy("_part", *group).orderBy(*sort).rowsBetween(W.unboundedPreceding, -1)
    parts = placed.groupBy("_part", *group).agg(
        total(F.col(value), F.struct(*order)).alias("_total")
    )
    # At most one row per partition and group.
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select("_part", *group, fold(F.col("_total")).over(earlier).alias("_carried"))
    here = placed.withColumn("_here", fold(F.col(value)).over(own))
    return join_on(here, carried, ["_part", *group]).select(
        *group, *order, merge(F.col("_carried"), F.col("_here")).alias(out)
    )


def _sum_before(blocks: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str):
    zero = F.lit(0)
    return fold_before(
        blocks,
        group,
        order,
        value,
        out,
        F.sum,
        lambda x, _: F.sum(x),
        lambda a, b: F.coalesce(a, zero) + F.coalesce(b, zero),
    )


def number_rows(
    rows: DataFrame,
    group: Sequence[str],
    ordinal: str,
    out: str = "seq_no",
    lead: Sequence[str] = (),
    start: int = 1,
    width: int = WIDTH,
) -> DataFrame:
    """Number the rows of each group from ``start`` without gaps.

    The order is ``lead`` columns ascending, then the unique whole number
    ``ordinal``.
    """
    blocks = [*lead, "_block"]
    keys = [*group, *blocks]
    cut = rows.withColumn("_block", F.floor(F.col(ordinal) / width))
    counts = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = _sum_before(counts, group, blocks, "_n", "_before")
    inside = W.partitionBy(*keys).orderBy(ordinal)
    local = cut.withColumn("_local", F.row_number().over(inside).cast("bigint"))
    return (
        join_on(local, offsets, keys)
        .withColumn(out, F.col("_before") + F.col("_local") + (start - 1))
        .drop("_block", "_local", "_before")
    )


def carry_forward(
    rows: DataFrame,
    group: Sequence[str],
    ordinal: str,
    value: Column,
    out: str,
    width: int = WIDTH,
) -> DataFrame:
    """Last non-null ``value`` at or before each row of its group."""
    keys = [*group, "_block"]
    cut = rows.withColumns(
        {"_block": F.floor(F.col(ordinal) / width), "_value": value}
    )
    last = cut.groupBy(*keys).agg(
        F.max_by(
            "_value", F.when(F.col("_value").isNotNull(), F.col(ordinal))
        ).alias("_last")
    )
    carried = fold_before(
        last,
        group,
        ["_block"],
        "_last",
        "_carried",
        lambda x: F.last(x, ignorenulls=True),
        lambda x, at: F.max_by(x, F.when(x.isNotNull(), at)),
        lambda a, b: F.coalesce(b, a),
    )
    inside = (
        W.partitionBy(*keys).orderBy(ordinal).rowsBetween(W.unboundedPreceding, 0)
    )
    local = cut.withColumn("_here", F.last("_value", ignorenulls=True).over(inside))
    return (
        join_on(local, carried, keys)
        .withColumn(out, F.coalesce("_here", "_carried"))
        .drop("_block", "_value", "_here", "_carried")
    )


def running_sum(
    rows: DataFrame,
    group: Sequence[str],
    ordinal: str,
    value: Column,
    out: str,
    width: int = WIDTH,
) -> DataFrame:
    """Sum of ``value`` over the rows strictly before each row of its group."""
    keys = [*group, "_block"]
    cut = rows.withColumns(
        {"_block": F.floor(F.col(ordinal) / width), "_value": value}
    )
    sums = cut.groupBy(*keys).agg(F.sum("_value").alias("_sum"))
    offsets = _sum_before(sums, group, ["_block"], "_sum", "_before")
    inside = (
        W.partitionBy(*keys).orderBy(ordinal).rowsBetween(W.unboundedPreceding, -1)
    )
    zero = F.lit(0)
    local = cut.withColumn("_here", F.coalesce(F.sum("_value").over(inside), zero))
    return (
        join_on(local, offsets, keys)
        .withColumn(out, F.col("_here") + F.coalesce("_before", zero))
        .drop("_block", "_value", "_here", "_before")
    )


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``.  Partial on the map side."""
    rest = [name for name in rows.columns if name not in keys]
    picked = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    )
    return picked.select(*keys, *[F.col(f"_first.{name}") for name in rest])


def fixed_batches(
    rows: DataFrame,
    group: Sequence[str],
    ordinal: str,
    size: int,
    lead: Sequence[str] = (),
    out: str = "batch_no",
) -> DataFrame:
    """Consecutive batches of ``size`` rows per group."""
    numbered = number_rows(rows, group, ordinal, "_row_no", lead)
    return numbered.withColumn(out, F.ceil(F.col("_row_no") / size)).drop("_row_no")


def sections(
    rows: DataFrame,
    group: Sequence[str],
    ordinal: str,
    is_start: Column,
    is_end: Column,
) -> DataFrame:
    """Rows from the first start marker up to the first later end marker.

    Without an end marker the section runs to the end of the group; groups
    without a start marker give no rows.
    """
    marked = rows.withColumns({"_start": is_start, "_end": is_end})
    starts = marked.filter("_start").groupBy(*group).agg(F.min(ordinal).alias("_from"))
    ends = (
        join_on(marked.filter("_end").select(*group, ordinal), starts, group, "inner")
        .filter(F.col(ordinal) > F.col("_from"))
        .groupBy(*group)
        .agg(F.min(ordinal).alias("_to"))
    )
    bounds = join_on(starts, ends, group)
    return (
        join_on(marked, bounds, group, "inner")
        .filter(
            (F.col(ordinal) >= F.col("_from"))
            & (F.col("_to").isNull() | (F.col(ordinal) < F.col("_to")))
        )
        .drop("_start", "_end", "_from", "_to")
    )
