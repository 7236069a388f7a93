"""Build of a bundle: contract rows of many packages, checked before they join.

Packages are a column, not a loop: all rows are checked in one pass, and a
package with a row that breaks the contract becomes one issue row in the same
plan while the others go on.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.coverage import counts_by, duplicate_keys
from factloom.operators.sequence import join_on
from factloom.plans.schema import contract_row_schema, found_errors
from factloom.session import store

#: What a bundle is counted by: name, and path in a contract row by member and field.
DIMENSIONS = {
    "source": ("source", "source_name"),
    "period": ("period", "value"),
    "geography": ("geography", "level"),
    "entity": ("entity", "name"),
    "assertion": ("assertion", None),
}
KEYS = ["aggregate_fact_key", "semantic_fact_key"]


def _number_or_text(text: Column, is_number: Column) -> Column:
    """A JSON value: a number as it stands, else a string."""
    string = F.variant_get(F.parse_json(F.to_json(F.array(text))), "$[0]", "variant")
    return F.when(is_number, F.try_parse_json(text)).otherwise(string)


def contract_json(rows: DataFrame) -> Column:
    """JSON text of ``facts.consumer_rows``: the fields of the contract, no nulls.

    A constraint without a role is a filter.
    """
    pick = lambda group, *names: F.struct(*[F.col(f"{group}.{n}").alias(n) for n in names])
    period = F.struct(
        F.col("period.type").alias("type"),
        _number_or_text(F.col("period.value"), F.col("period.value_int").isNotNull()).alias("value"),
    )
    role = lambda c: F.coalesce(c["role"], F.lit("filter")).alias("role")
    term = lambda c: F.struct(*[c[n].alias(n) for n in ("variable", "operator", "value", "unit")], role(c))
    constraints = F.struct(
        F.col("universe_constraints.domain").alias("domain"),
        F.transform("universe_constraints.constraints", term).alias("constraints"),
    )
    special = {
        "value": _number_or_text(F.col("value"), F.col("value_type").isin("integer", "number", "decimal")),
        "period": period,
        "geography": pick("geography", "level", "id", "vintage"),
        "universe_constraints": constraints,
        # A fact without a relation between two concepts aligns nothing.
        "concept_alignment": F.when(
            F.col("concept_alignment.relation").isNotNull(), F.col("concept_alignment")
        ),
    }
    fields = [
        special.get(name, F.col(name)).alias(name) for name in rows.columns if name != "value_num"
    ]
    return F.to_json(F.struct(*fields))


class Bundle(NamedTuple):
    rows: DataFrame  # package, text and keys of the packages that hold
    packages: DataFrame  # package, row_count, invalid_rows, state
    issues: DataFrame  # package, code, severity, key, detail, n
    counts: DataFrame  # dim, key, n


def build_bundle(lines: DataFrame, requested: DataFrame | None = None, schema: dict | None = None) -> Bundle:
    """Bundle of ``lines`` (``package, text``: one contract row each).

    Every row is checked against ``schema`` once, before anything is put
    together, and the outcome is written.  A package with an invalid row is
    ``failed``: it gives the issue ``package_build_failed`` with its first error by
    location and the number of invalid rows, and none of its rows goes on.  A
    ``requested`` package without rows is ``package_without_rows``.  An aggregate
    key that repeats is an error of its key; repeated semantic keys are one
    warning with their number.  Without lines all parts are empty.
    """
    judged = found_errors(
        lines.select("package", "text"), "text", contract_row_schema() if schema is None else schema
    )
    # The members are read in one pass; what is inside them from their own short texts.
    members = {name: f"_{name}" for name in [*KEYS, *[member for member, _ in DIMENSIONS.values()]]}
    read = judged.select("package", "text", "found", F.json_tuple("text", *members).alias(*members.values()))
    dims = {
        f"dim_{name}": F.col(members[member]) if field is None else F.get_json_object(members[member], f"$.{field}")
        for name, (member, field) in DIMENSIONS.items()
    }
    checked = store(
        read.select(
            "package",
            "text",
            F.get("found", F.lit(0)).alias("error"),
            *[F.col(members[key]).alias(key) for key in KEYS],
            *[value.alias(name) for name, value in dims.items()],
        ),
        "bundle",
    )
    wrong = F.col("error").isNotNull()
    location = F.when(F.size("error.path") == 0, "<root>").otherwise(F.array_join("error.path", "/"))
    tallied = checked.groupBy("package").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(wrong).alias("invalid_rows"),
        F.min(F.when(wrong, F.struct("error.path", location.alias("at"), "error.rule"))).alias("_first"),
    )
    state = F.when(F.col("invalid_rows") > 0, "failed").otherwise("built")
    packages = tallied.withColumn("state", state)
    built = packages.filter("state = 'built'").select("package", F.lit(True).alias("_built"))
    # One row per package goes to the rows.
    kept = join_on(checked, built, ["package"], "inner")
    rows = kept.select("package", "text", *KEYS)

    def issues(frame: DataFrame, code: str, severity: str, **columns: Column) -> DataFrame:
        nothing = {"package": "string", "key": "string", "detail": "string", "n": "bigint"}
        return frame.select(
            F.lit(code).alias("code"),
            F.lit(severity).alias("severity"),
            *[columns.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in nothing.items()],
        )

    repeated = duplicate_keys(rows, "aggregate_fact_key")
    doubled = duplicate_keys(rows, "semantic_fact_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    listed = issues(
        packages.filter("state = 'failed'"),
        "package_build_failed",
        "error",
        package=F.col("package"),
        detail=F.concat_ws(": ", "_first.at", "_first.rule"),
        n=F.col("invalid_rows"),
    ).unionByName(
        issues(repeated, "duplicate_aggregate_fact_key", "error", key=F.col("aggregate_fact_key"), n=F.col("n"))
    ).unionByName(issues(doubled, "duplicate_semantic_fact_key", "warning", n=F.col("n")))
    if requested is not None:
        absent = join_on(
            requested.select("package").distinct(), packages.select("package", F.lit(True).alias("_there")), ["package"]
        ).filter("_there is null")
        listed = listed.unionByName(issues(absent, "package_without_rows", "error", package=F.col("package")))
    counts = counts_by(kept, {name: F.col(f"dim_{name}") for name in DIMENSIONS})
    return Bundle(rows, packages.drop("_first"), listed, counts)
