"""Validation as data: rules give issue rows, never exceptions.

A rule is ``(code, field, test)``.  All rules of a table are evaluated in one
pass inside generated code; rows without an issue leave nothing behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUE = "struct<code:string,field:string>"


class Rule(NamedTuple):
    code: str
    field: str
    test: Column


def blank(value: Column) -> Column:
    """Null or white space only."""
    return value.isNull() | (F.trim(value.cast("string")) == "")


def outside(value: Column, allowed: Sequence[str]) -> Column:
    """Null or not one of the allowed values."""
    return ~F.coalesce(value.isin(list(allowed)), F.lit(False))


def issue(code: str, field: str | Column) -> Column:
    name = F.lit(field) if isinstance(field, str) else field
    return F.struct(F.lit(code).alias("code"), name.alias("field")).cast(ISSUE)


def issue_array(rules: Sequence[Rule], more: Sequence[Column] = ()) -> Column:
    """Issues of one row; ``more`` are extra arrays of issues."""
    fixed = F.array_compact(
        F.array(
            *[
                F.when(F.coalesce(rule.test, F.lit(False)), issue(rule.code, rule.field))
                for rule in rules
            ]
        )
    )
    return F.concat(fixed, *more) if more else fixed


def issue_rows(
    rows: DataFrame,
    keep: Sequence[str],
    rules: Sequence[Rule],
    more: Sequence[Column] = (),
) -> DataFrame:
    """One row per broken rule: ``keep`` columns, code and field."""
    return rows.select(*keep, F.inline(issue_array(rules, more)))


def duplicate_issues(
    rows: DataFrame, key: str, position: str, code: str = "duplicate_key"
) -> DataFrame:
    """One issue per repeated key with its first position and its count."""
    return (
        rows.groupBy(key)
        .agg(F.min(position).alias(position), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .withColumn("code", F.lit(code))
    )


def first_error(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """First issue of each row by field, then code."""
    return rows.groupBy(*key).agg(F.min(F.struct("field", "code")).alias("_e")).select(
        *key, "_e.field", "_e.code"
    )


def issue_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("code", "field").agg(F.count(F.lit(1)).alias("n"))


def raise_if_any(issues: DataFrame, limit: int = 5) -> None:
    """Strict mode: raise with the first few issues.

    The limit bounds the message, not the check.
    """
    found = issues.limit(limit).collect()
    if found:
        raise ValueError("; ".join(str(row.asDict()) for row in found))
