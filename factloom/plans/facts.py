"""Facts as nested rows: building, labels, constraints, consumer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import keys as K
from factloom.functions.scalars import humanize

# Flat column -> (group, field).  A fact groups its columns in structs.
FACT_GROUPS = {
    "period": {
        "type": "period_type",
        "value": "period_value",
        "value_int": "period_int",
    },
    "geography": {
        "level": "geography_level",
        "id": "geography_id",
        "vintage": "geography_vintage",
        "name": "geography_name",
    },
    "entity": {"name": "entity_name", "role": "entity_role"},
    "measure": {
        "concept": "concept",
        "unit": "unit",
        "source_concept": "source_concept",
        "concept_relation": "concept_relation",
        "concept_authority": "concept_authority",
        "concept_evidence_url": "concept_evidence_url",
        "concept_evidence_notes": "concept_evidence_notes",
        "legal_vintage": "legal_vintage",
    },
    "aggregation": {"method": "aggregation_method", "denominator": "denominator"},
    "source": {
        name: name
        for name in (
            "source_name",
            "source_table",
            "source_file",
            "url",
            "vintage",
            "extracted_at",
            "extraction_method",
            "method_notes",
            "source_sha256",
            "source_size_bytes",
            "raw_bucket",
            "raw_key",
            "raw_uri",
        )
    },
    "layout": {
        name: name
        for name in (
            "record_set_id",
            "record_set_spec_id",
            "groupby_dimension",
            "groupby_value_id",
            "groupby_value_label",
            "groupby_ordinal",
            "measure_id",
            "measure_label",
            "measure_ordinal",
            "source_row_id",
            "source_column_id",
            "table_record_kind",
        )
    },
    "period_coverage": {
        "start_date": "coverage_start",
        "end_date": "coverage_end",
        "basis": "coverage_basis",
        "accounting_basis": "accounting_basis",
    },
}
NUMBERED = {"period_int", "source_size_bytes", "groupby_ordinal", "measure_ordinal"}
CONSTRAINT = (
    "struct<variable:string,operator:string,value:string,unit:string,"
    "role:string,label:string>"
)


def nest_facts(flat: DataFrame) -> DataFrame:
    """Flat fact columns to fact rows; absent flat columns become nulls.

    Columns that belong to no group (value, filters, constraints, lineage …)
    are kept as they are.
    """
    present = set(flat.columns)

    def field(source: str, name: str) -> Column:
        kind = "bigint" if source in NUMBERED else "string"
        value = F.col(source) if source in present else F.lit(None)
        return value.cast(kind).alias(name)

    used = {name for fields in FACT_GROUPS.values() for name in fields.values()}
    return flat.select(
        *[name for name in flat.columns if name not in used],
        *[
            F.struct(*[field(source, name) for name, source in fields.items()]).alias(
                group
            )
            for group, fields in FACT_GROUPS.items()
        ],
    )


def flatten_facts(facts: DataFrame) -> DataFrame:
    """One wide row per fact; maps and coverage as JSON text."""
    flat = [
        F.col(f"{group}.{name}").alias(column)
        for group, fields in FACT_GROUPS.items()
        if group != "period_coverage"
        for name, column in fields.items()
    ]
    coverage = F.col("period_coverage")
    stated = F.coalesce(*[coverage[name] for name in FACT_GROUPS["period_coverage"]])
    rest = [
        name
        for name in facts.columns
        if name not in FACT_GROUPS and name not in ("filters", "constraints")
    ]
    return facts.select(
        *rest,
        *flat,
        F.to_json("filters").alias("filters_json"),
        F.when(stated.isNotNull(), F.to_json(coverage)).alias("coverage_json"),
    )


def constraint(
    variable: Column | str,
    operator: str,
    value: Column | str,
    unit: str | None = None,
    label: Column | str | None = None,
) -> Column:
    text = lambda item: F.lit(item) if not isinstance(item, Column) else item
    return F.struct(
        text(variable).alias("variable"),
        F.lit(operator).alias("operator"),
        text(value).alias("value"),
        F.lit(unit).alias("unit"),
        F.lit(None).alias("role"),
        text(label).alias("label"),
    ).cast(CONSTRAINT)


# --- fixed values: filters with a known meaning ------------------------------
STATUS_FILTER = "filing_status"
STATUS_VARIABLE = "irs_soi.filing_status"
LOWER_FILTER, UPPER_FILTER = "agi_lower_usd", "agi_upper_usd"
INCOME_VARIABLE = "irs_soi.adjusted_gross_income"
CHILD_FILTER = "eitc_child_count"
CHILD_VARIABLE = "us.tax.earned_income_credit_qualifying_children"
IGNORED_FILTER = "income_range"
# ----------------------------------------------------------------------------


def filter_constraints(filters: Column) -> Column:
    """Constraints implied by the filter map alone."""

    def value(name: str) -> Column:
        return F.try_element_at(filters, F.lit(name))

    def optional(test: Column, item: Column) -> Column:
        empty = F.array().cast(f"array<{CONSTRAINT}>")
        return F.when(test, F.array(item)).otherwise(empty)

    def stated(name: str) -> Column:
        return F.coalesce(value(name) != "all", F.lit(False))

    status, lower, upper, children = (
        value(name) for name in (STATUS_FILTER, LOWER_FILTER, UPPER_FILTER, CHILD_FILTER)
    )
    child_label = "EITC qualifying children"
    income = "Adjusted gross income"
    handled = [STATUS_FILTER, LOWER_FILTER, UPPER_FILTER, IGNORED_FILTER, CHILD_FILTER]
    rest = F.filter(
        F.array_sort(F.map_entries(filters)),
        lambda item: ~item["key"].isin(handled)
        & item["value"].isNotNull()
        & (item["value"] != "all"),
    )
    return F.concat(
        optional(
            stated(STATUS_FILTER),
            constraint(STATUS_VARIABLE, "==", status, label="Filing status"),
        ),
        optional(
            lower.isNotNull(),
            constraint(INCOME_VARIABLE, ">=", lower, "usd", f"{income} lower bound"),
        ),
        optional(
            upper.isNotNull(),
            constraint(INCOME_VARIABLE, "<", upper, "usd", f"{income} upper bound"),
        ),
        optional(
            stated(CHILD_FILTER) & (children == "3plus"),
            constraint(CHILD_VARIABLE, ">=", "3", "count", child_label),
        ),
        optional(
            stated(CHILD_FILTER) & (children != "3plus"),
            constraint(CHILD_VARIABLE, "==", children, "count", child_label),
        ),
        F.transform(
            rest,
            lambda item: constraint(
                item["key"], "==", item["value"], label=humanize(item["key"])
            ),
        ),
    )


def effective_constraints() -> Column:
    """Explicit constraints where the fact has any, else the implied ones."""
    return F.when(F.size("constraints") > 0, F.col("constraints")).otherwise(
        filter_constraints(F.col("filters"))
    )


def fact_label() -> Column:
    """Human label from the parts of a fact."""
    method = F.col("aggregation.method")
    counted = (method == "sum") & (F.col("measure.unit") == "count")
    aggregation = F.when(counted, "count").otherwise(humanize(method))
    aggregation = F.concat(
        F.when(F.col("assertion") == "source_projection", "projected ").otherwise(""),
        aggregation,
    )
    entries = F.array_sort(F.map_entries("filters"))
    filters = F.array_join(
        F.transform(
            entries,
            lambda item: F.concat(
                humanize(item["key"]),
                F.lit("="),
                humanize(F.coalesce(item["value"], F.lit("None"))),
            ),
        ),
        ", ",
    )
    source = F.concat_ws(" ", "source.source_name", "source.source_table")
    name = F.col("geography.name")
    return F.concat(
        F.coalesce(F.when(name != "", name), F.col("geography.id")),
        F.lit(" "),
        F.col("period.value"),
        F.lit(" "),
        humanize(F.col("period.type")),
        F.lit(" "),
        aggregation,
        F.lit(" "),
        humanize(F.col("measure.concept")),
        F.lit(" for "),
        humanize(F.col("entity.name")),
        F.when(F.size(entries) > 0, F.concat(F.lit(" ("), filters, F.lit(")"))).otherwise(
            ""
        ),
        F.when(source != "", F.concat(F.lit(" ["), source, F.lit("]"))).otherwise(""),
    )


def facts_from_records(records: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Resolved records joined to their source artifact, labelled."""
    sources = artifacts.withColumn(
        "extraction_method", F.lit("cell selectors resolved from cells")
    )
    facts = nest_facts(records.join(sources, "artifact_sha256", "left"))
    return facts.withColumn("label", fact_label())


def consumer_rows(facts: DataFrame) -> DataFrame:
    """Contract rows: all keys and the payload, one select over the facts."""
    keyed = K.with_fact_keys(facts)
    return keyed.select(
        F.lit("consumer_fact.v1").alias("schema_version"),
        "aggregate_fact_key",
        "semantic_fact_key",
        "legacy_fact_key",
        "source_release_key",
        "source_series_key",
        "observed_measure_key",
        "dimension_set_key",
        "universe_constraint_set_key",
        F.col("value_text").alias("value"),
        "value_num",
        "value_type",
        "assertion",
        "provenance_class",
        "survey_instrument",
        "period",
        "geography",
        "entity",
        "aggregation",
        F.struct(
            F.col("source.source_name").alias("source_name"),
            F.col("source.source_table").alias("source_table"),
            K.source_measure_id().alias("source_measure_id"),
            K.source_concept_or_concept().alias("source_concept"),
            F.col("measure.unit").alias("unit"),
        ).alias("observed_measure"),
        F.map_filter("filters", lambda _, value: value.isNotNull()).alias("dimensions"),
        F.struct("domain", "constraints").alias("universe_constraints"),
        F.when(
            F.col("concept_alignment_key").isNotNull(),
            F.struct(
                "concept_alignment_key",
                F.col("measure.source_concept").alias("source_concept"),
                F.col("measure.concept").alias("canonical_concept"),
                F.col("measure.concept_relation").alias("relation"),
                F.col("measure.concept_authority").alias("authority"),
                F.col("measure.legal_vintage").alias("legal_vintage"),
            ),
        ).alias("concept_alignment"),
        "source",
        "layout",
        F.struct("source_record_id", "source_cell_keys", "source_row_keys").alias(
            "lineage"
        ),
        "label",
    )


def pruned_json(columns: dict[str, Column], nested: dict[str, dict[str, Column]]) -> Column:
    """JSON text without nulls, empty arrays, empty maps or all-null structs."""
    parts = [value.alias(name) for name, value in columns.items()]
    for group, fields in nested.items():
        stated = F.coalesce(*[value.cast("string") for value in fields.values()])
        body = F.struct(*[value.alias(name) for name, value in fields.items()])
        parts.append(F.when(stated.isNotNull(), body).alias(group))
    return F.to_json(F.struct(*parts))


def none_if_empty(collection: Column) -> Column:
    return F.when(F.size(collection) > 0, collection)
