"""Registry of named queries with their ANSI-SQL twins, and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``name``; ``sql`` is the equivalent query on the same tables."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name!r}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(
    spark: SparkSession, folder: str, name: str, heavy: bool = False
) -> DataFrame:
    """One of the given tables; ``heavy`` work on it should use every core."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(rows) if heavy else rows


# --- SQL text helpers shared by the oracles ----------------------------------
def sql_number_text(x: str) -> str:
    return (
        f"(CASE WHEN {x} = floor({x}) AND abs({x}) < 9.2e18 "
        f"THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)"
    )


def sql_escape(x: str) -> str:
    return rf"replace(replace(CAST({x} AS VARCHAR), '\', '\\'), '|', '\|')"


def sql_record(fields: dict[str, str], keep_nulls: bool = False) -> str:
    parts = []
    for name, value in fields.items():
        text = f"('{name}=' || {sql_escape(value)})"
        parts.append(f"coalesce({text}, '{name}')" if keep_nulls else text)
    return f"concat_ws('|', {', '.join(parts)})"


def sql_digest(namespace: str, text: str, length: int = 24) -> str:
    return f"('{namespace}:' || substr(sha256({text}), 1, {length}))"


def sql_finite(x: str) -> str:
    return (
        rf"(CASE WHEN regexp_full_match({x}, "
        rf"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') "
        f"THEN TRY_CAST({x} AS DOUBLE) END)"
    )
