"""Work items of a source inventory: stage, priority, blockers, batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.scalars import path_slug
from factloom.operators.sequence import number_rows

#: ``{column: allowed values}``; all columns must agree.  ``None`` allows any
#: value but null and empty text.
Conditions = Mapping[str, Sequence[object] | None]
#: A result and the conditions it needs; a result of the form ``("column", c)``
#: is the value of column ``c``.
Rule = tuple[object, Conditions]


def holds(conditions: Conditions) -> Column:
    test = F.lit(True)
    for name, allowed in conditions.items():
        stated = F.col(name).isNotNull() & (F.col(name).cast("string") != "")
        test = test & (stated if allowed is None else F.col(name).isin(*allowed))
    return F.coalesce(test, F.lit(False))


def _result(result: object) -> Column:
    return F.col(result[1]) if isinstance(result, tuple) else F.lit(result)


def first_match(rules: Sequence[Rule]) -> Column:
    """Result of the first rule that holds, null if none does.

    A rule without conditions holds always, so a table may end with a default.
    """
    return F.coalesce(*[F.when(holds(test), _result(found)) for found, test in rules])


def every_match(rules: Sequence[Rule]) -> Column:
    """Results of all rules that hold, in their order, as an array."""
    return F.array_compact(F.array(*[F.when(holds(test), _result(found)) for found, test in rules]))


def classify(
    items: DataFrame,
    stages: Sequence[Rule],
    priorities: Sequence[Rule],
    blockers: Sequence[Rule],
) -> DataFrame:
    """Stage, priority and blockers of each item by three rule tables.

    Rules for priorities and blockers may name the column ``stage``.
    """
    staged = items.withColumn("stage", first_match(stages))
    return staged.withColumns(
        {"priority": first_match(priorities), "blockers": every_match(blockers)}
    )


def batches(
    items: DataFrame, ordinal: str, lead: Sequence[str], size: int, prefix: str
) -> DataFrame:
    """Items with their batch id: fixed-size runs per stage, priority first.

    ``ordinal`` is the position of an item inside equal ``lead`` values.
    """
    ranked = items.withColumn("_rank", -F.col("priority"))
    numbered = number_rows(ranked, ["stage"], ordinal, "_no", ["_rank", *lead])
    chunk = F.ceil(F.col("_no") / size)
    label = F.concat_ws(
        "-",
        F.lit(prefix),
        path_slug(F.col("stage")),
        F.lpad(chunk.cast("string"), F.greatest(F.lit(3), F.length(chunk.cast("string"))), "0"),
    )
    return numbered.withColumn("batch_id", label).drop("_no", "_rank")


def batch_report(batched: DataFrame) -> DataFrame:
    return batched.groupBy("stage", "batch_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.min("priority").alias("priority_min"),
        F.max("priority").alias("priority_max"),
    )
