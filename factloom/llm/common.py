"""Helpers of the training-data operators: shared tables, blocks, numbering."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Unicode White_Space as the content of a character class.
SPACES = "\t-\r \x85\xa0  -     　"

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only where that is unset in a local session (tests) a temporary folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="spark-"))
        folder = _own_folder[0]
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write ``rows`` to the shared folder once and read them back.

    Cuts the lineage; the copy does not depend on any executor.
    """
    spark, schema = rows.sparkSession, rows.schema
    path = new_path(spark, label)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


#: A side of narrow rows (some numbers each) up to this many is broadcast, at
#: most about 200 MB; a larger one is shuffled.
FEW = 4_000_000


def if_few(rows: DataFrame) -> DataFrame:
    """``rows``, which must be narrow and cheap to count, marked for broadcast
    if they are at most ``FEW``."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def small_batches(spark: SparkSession) -> None:
    """Rows with whole texts go to Python in batches of some megabytes.

    A batch is held several times at once, in the executor and in its worker; by
    default it has 10 000 rows, whatever their size.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 * 2**20))


_holder: list = []


def sole_use(owner: str, release: Callable[[], None] = lambda: None) -> None:
    """Called where a task of ``owner`` starts in a Python worker.

    A worker outlives its tasks and may keep tables between those of one
    operator; when another operator's tasks come, ``release`` drops them.
    """
    if _holder and _holder[0][0] != owner:
        _holder.pop()[1]()
    if not _holder:
        _holder.append((owner, release))


def shielded(rows: DataFrame, needed: tuple[str, ...]) -> DataFrame:
    """``rows`` with all columns but ``needed`` under names nothing else uses."""
    return rows.select(
        *needed,
        *[F.col(c).alias(f"__{i}") for i, c in enumerate(rows.columns) if c not in needed],
    )


def restored(rows: DataFrame, columns: list[str], needed: tuple[str, ...]) -> DataFrame:
    """The ``columns`` of the frame that was ``shielded``, in their order."""
    return rows.select(
        *[F.col(c if c in needed else f"__{i}").alias(c) for i, c in enumerate(columns)]
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sort_key(column: str) -> Column:
    """A long to order by: null comes first, as the smallest long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(-(2**63)))


def split_points(rows: DataFrame, key: str, pieces: int) -> list[int]:
    """At most ``pieces`` - 1 values of ``key`` that cut the rows evenly."""
    shares = [i / pieces for i in range(1, pieces)]
    if not shares:
        return []
    found = rows.agg(
        F.percentile_approx(key, shares, max(10_000, 10 * pieces)).alias("at")
    ).first()["at"]
    return sorted(set(found or []))


def block_of(key: str, points: list[int]) -> Column:
    """How many of the sorted ``points`` are not above ``key``, in two steps."""
    if not points:
        return F.lit(0)
    width = max(1, int(len(points) ** 0.5))
    runs = [points[i : i + width] for i in range(0, len(points), width)]
    text = lambda xs: "array(" + ",".join(f"{_long(x)}" for x in xs) + ")"
    heads = text([run[0] for run in runs])
    nested = "array(" + ",".join(text(run) for run in runs) + ")"
    run = f"size(filter({heads}, x -> x <= {key}))"
    inside = f"size(filter(element_at({nested}, greatest({run}, 1)), x -> x <= {key}))"
    return F.expr(f"int({width} * greatest({run} - 1, 0) + {inside})")


def _long(value: int) -> str:
    if value == -(2**63):
        return "(-9223372036854775807L - 1L)"
    return f"{value}L"


def numbered(
    rows: DataFrame, group: list[str], order: list[str], per_block: int = 20_000
) -> DataFrame:
    """Add ``rank`` (from 0) within ``group``; hot groups are cut into blocks.

    A group of n rows is dealt by hash of ``order`` into about n / ``per_block``
    blocks; each block is ranked alone and starts where the blocks before end.
    The rank is any fixed order of the rows, not the order of ``order``; rows
    that are equal in ``order`` keep neighbouring ranks.
    """
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("_blocks", F.expr(f"_n div {per_block} + 1"))
    dealt = _join(rows, sizes.drop("_n"), group).withColumn(
        "_block", F.pmod(F.xxhash64(*order), F.col("_blocks"))
    )
    counts = dealt.groupBy(*group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block")
    starts = counts.withColumn(
        "_start",
        F.coalesce(
            F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).drop("_n")
    inside = Window.partitionBy(*group, "_block").orderBy(*order)
    ranked = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    return (
        _join(ranked, starts, [*group, "_block"])
        .withColumn("rank", F.col("_start") + F.col("_in"))
        .drop("_blocks", "_block", "_start", "_in")
    )


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys are equal."""
    names = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    match = [left[k].eqNullSafe(right[names[k]]) for k in keys]
    return left.join(right, match).drop(*names.values())


null_safe_join = _join
