"""Operator 2: mixing sources to target weights by entropy balancing.

Each source has a target number of words.  Among all rates r of its documents
that meet the target, 0 <= r <= 3, the mix takes the ones nearest to "each
document once" in relative entropy.  Convex duality gives their form: with one
multiplier per source,

    r = min(3, exp(multiplier * size / mean size of the source))

and the multiplier solves sum(size * r) = target, which rises with it.  It is
found by Newton steps that stay inside a bracket.  All steps run over the table
(source, size, documents): documents of one source and size have one rate, so
that table says all there is, and every step is one Spark aggregation over it.

Rates become whole copies along that table, from long to short documents: each
size takes the number of copies that brings the words taken so far nearest to
the words wanted so far.  Within a size the copies go round by rank.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import null_safe_join, numbered, restored, shielded, stored

CAP = 3
#: Relative distance to the target at which a source's multiplier is settled.
CLOSE = 1e-9
#: Newton steps between two looks at how far the sources are from their target.
STEPS, ROUNDS = 4, 60


def sized(documents: DataFrame) -> DataFrame:
    """``documents`` with ``size``, the runs of characters that are not ASCII
    white space; null text: 0."""
    words = r"[^\x20\x09-\x0D]+"
    return documents.withColumn(
        "size", F.coalesce(F.expr(f"regexp_count(text, r'{words}')"), F.lit(0)).cast("long")
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Add ``target`` to (source, source_size): shares of the sum by weight.

    Sources in order of code points, null last, take ``weights`` in turn.  A
    target stops at 3 times the source's size; what is above is shared among the
    others by weight until none is above.  Those that stop are the first ones in
    order of size per weight, so one running sum finds them.  One row per source
    is ordered here, not the documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    every = Window.partitionBy()
    by_need = Window.orderBy("_ratio", F.col("source").isNull(), "source")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn(
        "_weight", turn[((F.row_number().over(by_name) - 1) % len(weights)).cast("int")]
    )
    rows = rows.withColumn("_cap", CAP * F.col("source_size").cast("double"))
    rows = rows.withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    # What is left, per weight left, if all before this one have stopped.
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight = F.sum("_weight").over(every) - F.coalesce(
        F.sum("_weight").over(before), F.lit(0.0)
    )
    rows = rows.withColumn("_level", left / weight)
    rows = rows.withColumn("_stops", F.col("_ratio") <= F.col("_level"))
    # The first source that does not stop has the greatest level left.
    open_level = F.max(F.when(~F.col("_stops"), F.col("_level"))).over(every)
    target = F.when(F.col("_stops"), F.col("_cap")).otherwise(F.col("_weight") * open_level)
    return rows.withColumn("target", target).select("source", "source_size", "target")


def multipliers(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per source: mean, source_size, target, multiplier.

    ``table``: source, size, n; ``wanted``: source, source_size, target.  A
    source whose target is its cap, or that has no words, has multiplier null.
    """
    means = table.groupBy("source").agg(
        # A source without words has no scale of its own.
        F.greatest(F.sum(F.col("size") * F.col("n")) / F.sum("n"), F.lit(1.0)).alias("mean"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
    )
    state = null_safe_join(wanted, means, ["source"])
    # From this multiplier on every document of the source takes its cap.
    high = F.log(F.lit(float(CAP))) * F.col("mean") / F.col("least")
    full = F.col("target") >= CAP * F.col("source_size") * (1 - 1e-12)
    state = state.withColumn("done", F.col("least").isNull() | full).select(
        "source",
        "source_size",
        "target",
        "mean",
        F.lit(0.0).alias("at"),
        F.lit(-750.0).alias("low"),
        high.alias("high"),
        "done",
    )
    state = stored(state, "multipliers")
    for _ in range(ROUNDS):
        for _ in range(STEPS):
            state = _step(table, state)
        state = stored(state, "multipliers")
        if not state.filter("not done").head(1):
            break
    settled = F.when(F.col("target") < CAP * F.col("source_size") * (1 - 1e-12), F.col("at"))
    return state.select("source", "source_size", "target", "mean", settled.alias("multiplier"))


def _step(table: DataFrame, state: DataFrame) -> DataFrame:
    """One Newton step of every source that is not done, inside its bracket."""
    x = F.col("size") / F.col("mean")
    rate = F.exp(F.col("at") * x)
    words = F.col("n") * F.col("size")
    keys = ["source", "source_size", "target", "mean", "at", "low", "high", "done"]
    rows = (
        null_safe_join(table, state, ["source"])
        .groupBy(*keys)
        .agg(
            F.sum(words * F.when(rate < CAP, rate).otherwise(float(CAP))).alias("taken"),
            F.sum(F.when(rate < CAP, words * x * rate).otherwise(0.0)).alias("slope"),
        )
    )
    gap = F.col("taken") - F.col("target")
    low = F.when(gap < 0, F.col("at")).otherwise(F.col("low"))
    high = F.when(gap > 0, F.col("at")).otherwise(F.col("high"))
    rows = rows.select(*keys, gap.alias("gap"), "slope", low.alias("low2"), high.alias("high2"))
    step = F.when(F.col("slope") > 0, F.col("at") - F.col("gap") / F.col("slope"))
    inside = (step > F.col("low2")) & (step < F.col("high2"))
    close = F.abs("gap") <= CLOSE * F.col("target")
    width = F.abs(F.col("high2")) + F.abs(F.col("low2"))
    tight = (F.col("high2") - F.col("low2")) <= 1e-13 * width
    moved = F.when(inside, step).otherwise((F.col("low2") + F.col("high2")) / 2)
    return rows.select(
        "source",
        "source_size",
        "target",
        "mean",
        F.when(F.col("done") | close, F.col("at")).otherwise(moved).alias("at"),
        F.when(F.col("done"), F.col("low")).otherwise(F.col("low2")).alias("low"),
        F.when(F.col("done"), F.col("high")).otherwise(F.col("high2")).alias("high"),
        (F.col("done") | close | tight).alias("done"),
    )


def _rounded(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies per size of one source, long documents first."""
    rows = rows.sort_values("size", ascending=False)
    size, n = rows["size"].to_numpy(), rows["n"].to_numpy()
    wanted = np.cumsum(size * n * rows["rate"].to_numpy())
    copies, taken = np.zeros(len(rows), np.int64), 0
    for i in range(len(rows)):
        if size[i]:
            best = round((wanted[i] - taken) / size[i])
        else:
            best = round(n[i] * rows["rate"].iat[i])
        copies[i] = min(max(best, 0), CAP * n[i])
        taken += int(copies[i]) * int(size[i])
    return pd.DataFrame({"source": rows["source"], "size": size, "copies_of_size": copies})


def mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per row of ``documents`` (doc_id, source, text).

    Returns doc_id, source, size, source_size, target, rate and copies.  A null source is a source of its own, a null text has no
    words.  Repeated rows each count.  An empty table gives no rows.

    A document's copies depend on its id, size and source and on the table, not
    on the order of rows.
    """
    narrow = stored(sized(documents).select("doc_id", "source", "size"), "sizes")
    return _mixed(narrow, weights)


def _mixed(narrow: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    table = stored(
        narrow.groupBy("source", "size").agg(F.count("*").alias("n")), "size-table"
    )
    sources = table.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    found = multipliers(table, stored(targets(sources, weights), "targets"))
    rates = null_safe_join(table, found, ["source"])
    tilt = F.exp(F.col("multiplier") * F.col("size") / F.col("mean"))
    tilt = F.when(tilt > CAP, float(CAP)).otherwise(tilt)
    full = F.when(F.col("source_size") > 0, F.lit(float(CAP))).otherwise(1.0)
    rates = stored(rates.withColumn("rate", F.coalesce(tilt, full)), "rates")
    # A source has one row per different size here.
    kind = narrow.schema["source"].dataType.simpleString()
    whole = rates.select("source", "size", "n", "rate").groupBy("source").applyInPandas(
        _rounded, f"source {kind}, size long, copies_of_size long"
    )
    plan = stored(null_safe_join(rates, whole, ["source", "size"]), "plan").select(
        "source", "size", "n", "source_size", "target", "rate", "copies_of_size"
    )
    ranked = numbered(narrow, ["source", "size"], ["doc_id"])
    extra = (F.col("rank") < F.col("copies_of_size") % F.col("n")).cast("long")
    return null_safe_join(ranked, plan, ["source", "size"]).withColumn(
        "copies", F.expr("copies_of_size div n") + extra
    ).drop("n", "copies_of_size", "rank")


def with_copies(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The mixed corpus: each row of ``documents`` as often as the mix takes it.

    All columns stay.  Rows that the mix takes no copy of are left out.
    """
    needed = ("doc_id", "source", "text")
    held = shielded(documents, needed).withColumn("uid", F.monotonically_increasing_id())
    held = stored(held, "to-mix")
    # Ranks go by the id; the uid finds the row again.
    narrow = sized(held).select("doc_id", "source", "size", "uid")
    copies = _mixed(stored(narrow, "sizes"), weights).select("uid", "copies")
    rows = held.join(copies.filter("copies > 0"), "uid").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    return restored(rows, documents.columns, needed)


def op2_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mix(spark.read.parquet(f"{folder}/documents.parquet"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "rate",
        "copies",
    )
