"""Rule tables for facts, rows, cells, contracts, specs, profiles and files."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import keys as K
from factloom.functions.scalars import concept_leaf, iso_date, is_source_specific
from factloom.operators.issues import (
    ISSUE,
    Rule,
    blank,
    duplicate_issues,
    issue,
    issue_rows,
    outside,
)
from factloom.plans.facts import filter_constraints

# --- fixed values: closed enumerations -----------------------------------------
PERIOD_TYPES = ["calendar_year", "tax_year", "fiscal_year", "month"]
GEOGRAPHY_LEVELS = [
    "country",
    "region",
    "nuts1",
    "state",
    "county",
    "commune",
    "congressional_district",
    "state_legislative_district_upper",
    "state_legislative_district_lower",
    "parliamentary_constituency",
    "local_authority",
    "metro_area",
    "zip_code",
    "statistical_scope",
]
ENTITIES = [
    "person",
    "household",
    "tax_unit",
    "family",
    "benefit_unit",
    "return",
    "pension_plan",
    "government",
    "dwelling",
    "institutional_sector",
    "firm",
]
AGGREGATIONS = ["sum", "mean", "median", "rate", "ratio", "share"]
OPERATORS = ["==", "!=", ">", ">=", "<", "<=", "in"]
RELATIONS = ["exact", "broad_match", "narrow_match", "approximate", "source_label"]
ASSERTIONS = ["observation", "source_projection"]
PROVENANCE_CLASSES = ["administrative", "census", "model_output", "survey_aggregate"]
PERIOD_BASES = ["calendar", "tax", "fiscal", "survey_reference", "projection_horizon"]
ACCOUNTING_BASES = ["cash", "accrual"]
VALUE_TYPES = ["integer", "number", "decimal", "string", "boolean"]
# --------------------------------------------------------------------------------
COLUMN_SHAPE = "^[A-Z]{1,3}$"


def survey_rules(provenance: Column, instrument: Column) -> list[Rule]:
    """A survey needs its instrument; anything else must not name one."""
    known = ~outside(provenance, PROVENANCE_CLASSES)
    survey = provenance == "survey_aggregate"
    return [
        Rule("malformed_provenance_class", "provenance_class", ~known),
        Rule("missing_survey_instrument", "survey_instrument", survey & blank(instrument)),
        Rule(
            "misplaced_survey_instrument",
            "survey_instrument",
            known & ~survey & instrument.isNotNull(),
        ),
    ]


def fact_rules() -> list[Rule]:
    """Rules of one nested fact, apart from its filters and constraints."""
    c = F.col
    value, kind = c("value_text"), c("value_type")
    relation, stated = c("measure.concept_relation"), c("measure.source_concept")
    start, end = c("period_coverage.start_date"), c("period_coverage.end_date")
    basis = c("period_coverage.basis")
    accounting = c("period_coverage.accounting_basis")
    required = [
        ("measure.concept", c("measure.concept")),
        ("measure.unit", c("measure.unit")),
        ("domain", c("domain")),
        ("geography.id", c("geography.id")),
        ("source.source_name", c("source.source_name")),
        ("source.vintage", c("source.vintage")),
        ("source.extracted_at", c("source.extracted_at")),
        ("source.extraction_method", c("source.extraction_method")),
    ]
    enumerations = [
        ("malformed_period", "period.type", PERIOD_TYPES),
        ("malformed_geography", "geography.level", GEOGRAPHY_LEVELS),
        ("malformed_entity", "entity.name", ENTITIES),
        ("malformed_aggregation", "aggregation.method", AGGREGATIONS),
        ("malformed_assertion", "assertion", ASSERTIONS),
    ]
    bad_start = start.isNotNull() & iso_date(start).isNull()
    bad_end = end.isNotNull() & iso_date(end).isNull()
    coverage = "malformed_period_coverage"
    no_table = F.coalesce("source.source_table", F.lit("")) == ""
    no_file = F.coalesce("source.source_file", F.lit("")) == ""
    return [
        *[Rule("missing_field", name, blank(column)) for name, column in required],
        *[Rule(code, name, outside(c(name), ok)) for code, name, ok in enumerations],
        Rule("missing_period", "period.value", F.trim("period.value") == ""),
        *survey_rules(c("provenance_class"), c("survey_instrument")),
        Rule(
            "malformed_concept_relation",
            "measure.concept_relation",
            relation.isNotNull() & outside(relation, RELATIONS),
        ),
        Rule(
            "missing_field",
            "measure.source_concept",
            stated.isNotNull() & (F.trim(stated) == ""),
        ),
        Rule(
            "missing_field", "measure.concept_relation", (stated != "") & relation.isNull()
        ),
        Rule(
            "malformed_value",
            "value",
            value.isNull() | outside(kind, ["integer", "number", "decimal", "string"]),
        ),
        Rule("missing_value", "value", (kind == "string") & (F.trim(value) == "")),
        Rule("missing_provenance", "source.source_table", no_table & no_file),
        Rule(coverage, "period_coverage.start_date", bad_start),
        Rule(coverage, "period_coverage.end_date", bad_end),
        Rule(coverage, "period_coverage.start_date", iso_date(start) > iso_date(end)),
        Rule(
            coverage,
            "period_coverage.basis",
            basis.isNotNull() & outside(basis, PERIOD_BASES),
        ),
        Rule(
            coverage,
            "period_coverage.accounting_basis",
            accounting.isNotNull() & outside(accounting, ACCOUNTING_BASES),
        ),
    ]


def constraint_issues() -> Column:
    """Issues of the constraint list, with the position in the field name."""

    def check(item: Column, i: Column) -> Column:
        at = F.concat(F.lit("constraints."), i.cast("string"))
        return F.array_compact(
            F.array(
                F.when(
                    blank(item["variable"]),
                    issue("malformed_constraint", F.concat(at, F.lit(".variable"))),
                ),
                F.when(
                    outside(item["operator"], OPERATORS),
                    issue("malformed_constraint", F.concat(at, F.lit(".operator"))),
                ),
            )
        )

    return F.flatten(F.transform("constraints", check))


def filter_issues() -> Column:
    names = F.filter(F.map_keys("filters"), lambda key: F.trim(key) == "")
    return F.transform(names, lambda _: issue("malformed_filter", "filters"))


def validate_facts(facts: DataFrame) -> DataFrame:
    """Issue rows of facts: rules, duplicate keys and missing labels."""
    keyed = facts.withColumn("fact_key", K.fact_key())
    single = issue_rows(
        keyed,
        ["seq", "fact_key"],
        fact_rules(),
        [filter_issues(), constraint_issues()],
    ).withColumn("severity", F.lit("error"))
    unlabelled = keyed.filter(F.coalesce("label", F.lit("")) == "").select(
        "seq",
        "fact_key",
        F.lit("missing_label").alias("code"),
        F.lit("label").alias("field"),
        F.lit("warning").alias("severity"),
    )
    twins = duplicate_issues(keyed, "fact_key", "seq").select(
        "seq",
        "fact_key",
        "code",
        F.lit(None).cast("string").alias("field"),
        F.lit("error").alias("severity"),
    )
    return single.unionByName(unlabelled).unionByName(twins)


def validate_rows(rows: DataFrame, key: str, position: str) -> DataFrame:
    """Row rules; ``value_count`` is the number of values of a row."""
    rules = [
        Rule("missing_source_name", "source_name", blank(F.col("source_name"))),
        Rule("missing_artifact_sha256", "sha256", blank(F.col("sha256"))),
        Rule("malformed_coordinate", "row_number", F.col("row_number") < 1),
        Rule("missing_values", "values", F.col("value_count") == 0),
    ]
    single = issue_rows(rows, [position, key], rules).drop("field")
    twins = duplicate_issues(rows, key, position, "duplicate_source_row_key")
    return single.unionByName(twins.drop("copies"))


def validate_cells(cells: DataFrame, key: str, position: str) -> DataFrame:
    off_grid = (F.col("row_number") < 1) | (F.col("column_number") < 1)
    rules = [
        Rule("missing_source_name", "source_name", blank(F.col("source_name"))),
        Rule("missing_artifact_sha256", "sha256", blank(F.col("sha256"))),
        Rule("malformed_coordinate", "row_number", off_grid),
    ]
    single = issue_rows(cells, [position, key], rules).drop("field")
    twins = duplicate_issues(cells, key, position, "duplicate_source_cell_key")
    return single.unionByName(twins.drop("copies"))


def derived_source(store_names: Sequence[str], derived_roots: Sequence[str]) -> Column:
    """Why a fact does not cite a publisher; null when it does."""
    c = F.col
    in_root = F.lit(False)
    for root in derived_roots:
        in_root = in_root | c("source.raw_uri").startswith(root)
    return (
        F.when(F.lower("source.source_name").isin(list(store_names)), "cites_store")
        .when(c("source.source_file").startswith("derived:"), "cites_derived_file")
        .when(
            c("source.raw_bucket").endswith("-derived")
            | c("source.raw_key").startswith("derived/")
            | in_root,
            "cites_derived_location",
        )
        .when(c("source_record_id").endswith(".derived"), "cites_derived_record")
    )


def _constraint_text(item: Column, variable: Column | None = None) -> Column:
    parts = [variable if variable is not None else item["variable"]]
    parts += [item[name] for name in ("operator", "value", "unit", "role")]
    return F.concat_ws("|", *[F.coalesce(part, F.lit("-")) for part in parts])


def with_contract_columns(facts: DataFrame) -> DataFrame:
    """Working columns of the contract rules, each computed once per fact."""
    source_name = F.col("source.source_name")
    own = F.transform(
        F.filter(
            "_implied", lambda item: is_source_specific(source_name, item["variable"])
        ),
        lambda item: item["variable"],
    )
    return (
        facts.withColumn("_implied", filter_constraints(F.col("filters")))
        .withColumns({"_own": own, "_leaf": concept_leaf(F.col("layout.groupby_dimension"))})
        .withColumns(
            {
                "_expected": F.transform(
                    "_implied",
                    lambda item: _constraint_text(item, _canonical(item["variable"])),
                ),
                "_explicit": F.transform("constraints", lambda item: _constraint_text(item)),
            }
        )
    )


def _canonical(variable: Column) -> Column:
    dimension = F.col("layout.groupby_dimension")
    mapped = (
        F.array_contains("_own", variable)
        & (dimension != "")
        & (concept_leaf(variable) == F.col("_leaf"))
    )
    return F.when(F.coalesce(mapped, F.lit(False)), dimension).otherwise(variable)


def contract_issues(store_names: Sequence[str], derived_roots: Sequence[str]):
    """Rules and issue arrays over ``with_contract_columns``."""
    source_name = F.col("source.source_name")

    def copies(items: str, text: Column) -> Column:
        return F.size(F.filter(items, lambda other: other == text))

    # Multiset comparison inside one fact: its constraints are a short list.
    short = F.filter(
        F.array_distinct("_expected"),
        lambda text: copies("_explicit", text) < copies("_expected", text),
    )
    stated = F.size("constraints") > 0
    mismatch = F.when(
        stated,
        F.transform(short, lambda _: issue("constraint_filter_mismatch", "constraints")),
    ).otherwise(F.array().cast(f"array<{ISSUE}>"))
    specific = F.transform(
        F.filter(
            "constraints",
            lambda item: is_source_specific(source_name, item["variable"])
            | (_canonical(item["variable"]) != item["variable"]),
        ),
        lambda _: issue("source_specific_constraint_variable", "constraints"),
    )
    provenance = ["source_file", "source_sha256", "source_size_bytes", "raw_uri"]
    rules = [
        Rule(
            "implicit_constraints_from_filters",
            "constraints",
            (F.size("_implied") > 0) & ~stated,
        ),
        *[
            Rule(
                "missing_contract_provenance",
                f"source.{name}",
                F.coalesce(F.col(f"source.{name}").cast("string"), F.lit("")) == "",
            )
            for name in provenance
        ],
        Rule(
            "derived_fact_provenance",
            "source",
            derived_source(store_names, derived_roots).isNotNull(),
        ),
        *survey_rules(F.col("provenance_class"), F.col("survey_instrument")),
        Rule("missing_contract_lineage", "source_record_id", blank(F.col("source_record_id"))),
        Rule(
            "missing_contract_lineage",
            "source_cell_keys",
            F.coalesce(F.size("source_cell_keys"), F.lit(0)) == 0,
        ),
    ]
    required = {
        "value": F.col("value_text"),
        "period": F.col("period.value"),
        "geography": F.col("geography.id"),
        "entity": F.col("entity.name"),
        "aggregation": F.col("aggregation.method"),
        "dimensions": F.when(F.size("filters") > 0, F.lit("stated")),
        "universe_constraints": F.col("domain"),
    }
    rules += [
        Rule("missing_contract_field", name, value.isNull())
        for name, value in required.items()
        if name != "dimensions"
    ]
    return rules, [mismatch, specific]


def validate_contract(
    facts: DataFrame,
    store_names: Sequence[str] = ("factloom",),
    derived_roots: Sequence[str] = ("store://derived/",),
) -> DataFrame:
    rules, more = contract_issues(store_names, derived_roots)
    return issue_rows(with_contract_columns(facts), ["seq"], rules, more)


# --- fixed values: the contract row ---------------------------------------------
ROW_REQUIRED = [
    "schema_version",
    "aggregate_fact_key",
    "semantic_fact_key",
    "legacy_fact_key",
    "source_release_key",
    "source_series_key",
    "observed_measure_key",
    "dimension_set_key",
    "universe_constraint_set_key",
    "value",
    "value_type",
    "assertion",
    "provenance_class",
    "period",
    "geography",
    "entity",
    "aggregation",
    "observed_measure",
    "dimensions",
    "universe_constraints",
    "source",
    "lineage",
]
ROW_OPTIONAL = ["layout", "label", "concept_alignment", "survey_instrument"]
ROW_KEY_SPACES = {
    "aggregate_fact_key": "aggregate_fact.v2",
    "semantic_fact_key": "semantic_fact.v2",
    "legacy_fact_key": "fact.v1",
    "source_release_key": "source_release.v2",
    "source_series_key": "source_series.v2",
    "observed_measure_key": "observed_measure.v2",
    "dimension_set_key": "dimension_set.v2",
    "universe_constraint_set_key": "universe_constraint_set.v2",
}
ROW_ENUMS = {
    "value_type": VALUE_TYPES,
    "assertion": ASSERTIONS,
    "provenance_class": PROVENANCE_CLASSES,
}
ROW_OBJECTS = [
    "period",
    "geography",
    "entity",
    "aggregation",
    "observed_measure",
    "dimensions",
    "universe_constraints",
    "source",
    "lineage",
]
# ----------------------------------------------------------------------------------


def validate_json_rows(
    lines: DataFrame,
    keep: Sequence[str],
    text: str,
    required: Sequence[str] = tuple(ROW_REQUIRED),
    optional: Sequence[str] = tuple(ROW_OPTIONAL),
    key_spaces: Mapping[str, str] | None = None,
    enums: Mapping[str, Sequence[str]] | None = None,
    objects: Sequence[str] = tuple(ROW_OBJECTS),
) -> DataFrame:
    """Schema issues of JSON rows: absent, unknown or malformed fields."""
    spaces = ROW_KEY_SPACES if key_spaces is None else key_spaces
    closed = ROW_ENUMS if enums is None else enums
    names = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    top = lines.withColumn("_names", names).withColumn(
        "_v", F.from_json(text, "map<string,string>")
    )
    value = lambda name: F.try_element_at("_v", F.lit(name))
    has = lambda name: F.array_contains("_names", name)
    known = F.array(*[F.lit(name) for name in [*required, *optional]])
    unknown = F.transform(
        F.array_except("_names", known), lambda name: issue("unknown_field", name)
    )
    rules = [
        Rule("not_an_object", "", F.size("_names") == 0),
        *[Rule("missing_field", name, ~has(name)) for name in required],
        *[
            Rule("malformed_key", name, has(name) & ~F.coalesce(
                value(name).rlike(f"^{space.replace('.', chr(92) + '.')}:[0-9a-f]{{24}}$"),
                F.lit(False),
            ))
            for name, space in spaces.items()
        ],
        *[
            Rule("not_in_enumeration", name, has(name) & outside(value(name), allowed))
            for name, allowed in closed.items()
        ],
        *[
            Rule("not_an_object", name, has(name) & ~F.coalesce(value(name).startswith("{"), F.lit(False)))
            for name in objects
        ],
    ]
    if "survey_instrument" in optional:
        survey = F.coalesce(value("provenance_class") == "survey_aggregate", F.lit(False))
        stated = has("survey_instrument")
        rules += [
            Rule("missing_survey_instrument", "survey_instrument", survey & ~stated),
            Rule("misplaced_survey_instrument", "survey_instrument", ~survey & stated),
        ]
    return issue_rows(top, keep, rules, [unknown])


def non_finite_text(text: Column) -> Column:
    """Does JSON text hold a number that is not finite, at any depth?"""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', '""')
    tokens = F.regexp_extract_all(
        bare, F.lit(r"-?[0-9]+(?:\.[0-9]+)?[eE][+-]?[0-9]+"), F.lit(0)
    )
    huge = F.exists(
        tokens, lambda token: F.abs(token.try_cast("double")) == float("inf")
    )
    return bare.rlike(r"-?\b(NaN|Infinity)\b") | huge


def validate_spec_rows(rows: DataFrame, filters: str, constraints: str) -> DataFrame:
    """Authoring rules of spec rows, with duplicates inside a record set."""
    entries = F.filter(
        F.map_entries(filters),
        lambda item: item["value"].isNotNull() & (item["value"] != "all"),
    )
    detail = F.exists(
        entries, lambda item: ~item["key"].isin("filing_status", "income_range")
    ) & (F.col("table_record_kind") != "total")

    def unmatched(suffix: str, operator: str) -> Column:
        bounds = F.filter(
            F.map_entries(filters), lambda item: item["key"].endswith(suffix)
        )
        lacking = F.filter(
            bounds,
            lambda item: ~F.exists(
                constraints,
                lambda term: (term["operator"] == operator)
                & term["value"].eqNullSafe(item["value"]),
            ),
        )
        return F.transform(lacking, lambda item: issue("missing_bound_constraint", item["key"]))

    rules = [
        Rule(
            "malformed_row_column",
            "row_column",
            F.col("row_column").isNotNull() & ~F.col("row_column").rlike(COLUMN_SHAPE),
        ),
        Rule("missing_row_constraints", "constraints", detail & (F.size(constraints) == 0)),
    ]
    more = [unmatched("_lower_usd", ">="), unmatched("_upper_usd", "<")]
    single = issue_rows(rows, ["set_id", "value_id"], rules, more)
    return single.unionByName(_repeats(rows, "value_id", "duplicate_row_id")).unionByName(
        _repeats(rows, "row_ordinal", "duplicate_row_ordinal", "value_id")
    )


def _repeats(rows: DataFrame, name: str, code: str, id_name: str | None = None) -> DataFrame:
    repeated = (
        rows.groupBy("set_id", name)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    return repeated.select(
        "set_id",
        F.col(name).cast("string").alias(id_name or name),
        F.lit(code).alias("code"),
        F.lit(name).alias("field"),
    )


def validate_spec_measures(measures: DataFrame) -> DataFrame:
    relation, stated = F.col("concept_relation"), F.col("source_concept")
    no_evidence = blank(F.col("evidence_url")) & blank(F.col("evidence_notes"))
    rules = [
        Rule(
            "malformed_measure_column",
            "measure_column",
            ~F.coalesce(F.col("measure_column").rlike(COLUMN_SHAPE), F.lit(False)),
        ),
        Rule(
            "malformed_measure_aggregation",
            "aggregation",
            outside(F.col("aggregation"), AGGREGATIONS),
        ),
        Rule("missing_concept_evidence", "concept_relation", (relation == "exact") & no_evidence),
        Rule("missing_concept_relation", "concept_relation", (stated != "") & blank(relation)),
        Rule("missing_source_concept", "source_concept", (relation != "") & blank(stated)),
    ]
    single = issue_rows(measures, ["set_id", "measure_id"], rules)
    return single.unionByName(
        _repeats(measures, "measure_id", "duplicate_measure_id")
    ).unionByName(
        _repeats(measures, "measure_ordinal", "duplicate_measure_ordinal", "measure_id")
    )


def alignments_without_evidence(alignments: DataFrame) -> DataFrame:
    """Exact alignments that cite neither a URL nor notes."""
    none = blank(F.col("evidence_url")) & blank(F.col("evidence_notes"))
    return alignments.filter((F.col("relation") == "exact") & none).withColumn(
        "code", F.lit("missing_concept_evidence")
    )


def lacks_constraints() -> Column:
    """Grouped facts other than totals and areas need constraints."""
    dimension = F.col("layout.groupby_dimension")
    grouped = (
        (F.coalesce(dimension, F.lit("")) != "")
        & (dimension != "geography")
        & ~F.coalesce(F.col("layout.table_record_kind") == "total", F.lit(False))
    )
    has = (F.size("constraints") > 0) | (F.size(filter_constraints(F.col("filters"))) > 0)
    return F.coalesce(grouped, F.lit(False)) & ~has


def declared_mismatch(declared: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Entries whose declared count or digest differs from the actual one."""
    have = actual.select(
        key,
        F.col("row_count").alias("actual_count"),
        F.col("digest").alias("actual_digest"),
    )
    return (
        declared.join(have, key, "full_outer")
        .withColumn(
            "issue",
            F.when(F.col("actual_count").isNull(), "missing")
            .when(F.col("row_count").isNull(), "undeclared")
            .when(F.col("row_count") != F.col("actual_count"), "count_mismatch")
            .when(F.col("digest") != F.col("actual_digest"), "digest_mismatch"),
        )
        .filter(F.col("issue").isNotNull())
        .select(key, "row_count", "actual_count", "issue")
    )


def file_inventory(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest entries against stored files.

    ``manifest`` holds ``entry, filename, sha256, linked``; ``files`` holds
    ``filename, actual_sha256, size_bytes`` (``stored_files`` makes them).  A
    filename is a path from the same folder, so equal base names do not meet.
    """
    named = F.coalesce("filename", F.lit("")) != ""
    return manifest.join(files, "filename", "left").select(
        "entry",
        F.when(~named, "missing_filename")
        .when(F.col("actual_sha256").isNull(), "missing_file")
        .when(
            F.col("sha256").isNotNull() & (F.col("sha256") != F.col("actual_sha256")),
            "checksum_mismatch",
        )
        .alias("issue"),
        "size_bytes",
        F.coalesce("linked", F.lit(False)).alias("linked"),
    )


def stored_files(spark, path: str, chunk: int = 8 * 2**20) -> DataFrame:
    """Checksums of the files below the folder ``path``, named by their path from there.

    Spark lists the files, empty ones too; the task that gets a file hashes it as a
    stream, so a file of any size takes ``chunk`` bytes of memory.  Any file system
    that both Spark and Arrow reach will do.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    above = folder.toUri().getPath().rstrip("/") + "/"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    places = [(place,) for place in reader.load(path).inputFiles()]

    def digests(batches):
        for batch in batches:
            rows = [_stream_digest(place, chunk) for place in batch["place"]]
            names = [unquote(urlsplit(place).path) for place in batch["place"]]
            yield pd.DataFrame(
                {
                    "filename": [name[len(above) :] for name in names],
                    "actual_sha256": [digest for digest, _ in rows],
                    "size_bytes": [size for _, size in rows],
                }
            )

    # A task holds few files, as they may be large.
    listed = spark.createDataFrame(places, "place string").repartition(
        min(max(len(places), 1), 4096)
    )
    return listed.mapInPandas(digests, "filename string, actual_sha256 string, size_bytes long")


def _stream_digest(place: str, chunk: int) -> tuple[str, int]:
    system, name = pyarrow.fs.FileSystem.from_uri(quote(place, safe=":/@%"))
    digest, size = hashlib.sha256(), 0
    with system.open_input_stream(name) as stream:
        while part := stream.read(chunk):
            digest.update(part)
            size += len(part)
    return digest.hexdigest(), size


def validate_profiles(targets: DataFrame) -> DataFrame:
    """Repeated target ids and targets without a geography level."""
    repeated = (
        targets.groupBy("profile_id", "target_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("profile_id", "target_id", F.lit("duplicate_target_id").alias("code"))
    )
    empty = targets.filter(F.size("geography_levels") == 0).select(
        "profile_id", "target_id", F.lit("missing_geography_levels").alias("code")
    )
    return repeated.unionByName(empty)


def record_report(lookups: DataFrame, guards: DataFrame) -> DataFrame:
    """Resolution outcome per record from its value lookups and its guards.

    Both inputs hold ``record_id`` and ``issue``; the first issue by name is
    reported, lookups before guards.
    """
    ranked = lookups.select(
        "record_id", F.lit(1).alias("_rank"), "issue"
    ).unionByName(guards.select("record_id", F.lit(2).alias("_rank"), "issue"))
    failed = F.col("issue").isNotNull()
    return ranked.groupBy("record_id").agg(
        F.count_if((F.col("_rank") == 1) & ~failed).alias("value_cells"),
        F.min(F.when(failed, F.struct("_rank", "issue")))["issue"].alias("issue"),
    )
