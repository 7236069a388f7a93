"""Stable content keys of artifacts, cells, rows, facts and their parts.

The fact functions take the nested fact columns of ``plans.facts``.  Keys
ignore labels and layout.  The first-generation fact key keeps nulls and the
order of constraints; the second generation drops nulls, drops constraint
labels and sorts constraints.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import canonical as C

DEFAULT_ASSERTION = "observation"
CONSTRAINT_FIELDS = ("variable", "operator", "value", "unit", "role")


def _period() -> dict[str, Column]:
    return {
        "period_type": F.col("period.type"),
        "period_value": F.col("period.value"),
    }


def _place() -> dict[str, Column]:
    return {
        "geography_level": F.col("geography.level"),
        "geography_id": F.col("geography.id"),
        "geography_vintage": F.col("geography.vintage"),
    }


def _entity() -> dict[str, Column]:
    return {"entity": F.col("entity.name"), "entity_role": F.col("entity.role")}


def _aggregation() -> dict[str, Column]:
    return {
        "method": F.col("aggregation.method"),
        "denominator": F.col("aggregation.denominator"),
    }


def stated_assertion(assertion: Column) -> Column:
    """Null for the default, so that the default does not enter keys."""
    return F.when(assertion != DEFAULT_ASSERTION, assertion)


def constraint_text(item: Column, with_label: bool = False) -> Column:
    names = CONSTRAINT_FIELDS + (("label",) if with_label else ())
    return C.record({name: item[name] for name in names}, keep_nulls=with_label)


def fact_key() -> Column:
    """First-generation fact key."""
    constraints = F.when(
        F.size("constraints") > 0,
        C.sequence(
            F.transform("constraints", lambda item: constraint_text(item, True))
        ),
    )
    measure = (
        "concept",
        "unit",
        "source_concept",
        "concept_relation",
        "concept_authority",
        "concept_evidence_url",
        "concept_evidence_notes",
        "legal_vintage",
    )
    source = ("source_name", "source_table", "source_file", "vintage")
    fixed = C.record(
        {
            **_period(),
            **_place(),
            **_entity(),
            **{name: F.col(f"measure.{name}") for name in measure},
            **_aggregation(),
            "domain": F.col("domain"),
            "filters": C.mapping(F.col("filters")),
            **{name: F.col(f"source.{name}") for name in source},
        },
        keep_nulls=True,
    )
    optional = C.record(
        {
            "constraints": constraints,
            "assertion": stated_assertion(F.col("assertion")),
        }
    )
    return C.digest(
        "fact.v1", F.concat_ws("|", fixed, F.nullif(optional, F.lit("")))
    )


def source_release_key() -> Column:
    names = (
        "source_name",
        "source_table",
        "source_file",
        "url",
        "vintage",
        "source_sha256",
        "source_size_bytes",
        "raw_uri",
    )
    return C.digest(
        "source_release.v2", C.record({name: F.col(f"source.{name}") for name in names})
    )


def source_series_key() -> Column:
    return C.digest(
        "source_series.v2",
        C.record(
            {
                "source_name": F.col("source.source_name"),
                "source_table": F.col("source.source_table"),
                "record_set_spec_id": F.col("layout.record_set_spec_id"),
            }
        ),
    )


def source_measure_id() -> Column:
    measure_id = F.col("layout.measure_id")
    return F.coalesce(
        F.when(measure_id != "", measure_id), source_concept_or_concept()
    )


def source_concept_or_concept() -> Column:
    stated = F.col("measure.source_concept")
    return F.coalesce(F.when(stated != "", stated), F.col("measure.concept"))


def observed_measure_key() -> Column:
    return C.digest(
        "observed_measure.v2",
        C.record(
            {
                "source_name": F.col("source.source_name"),
                "source_table": F.col("source.source_table"),
                "source_measure_id": source_measure_id(),
                "source_concept": source_concept_or_concept(),
                "unit": F.col("measure.unit"),
            }
        ),
    )


def dimension_set_key() -> Column:
    return C.digest("dimension_set.v2", C.mapping(F.col("filters")))


def constraint_set_key() -> Column:
    ordered = F.array_sort(
        F.transform("constraints", lambda item: constraint_text(item))
    )
    return C.digest(
        "universe_constraint_set.v2",
        C.record(
            {
                "domain": F.col("domain"),
                "constraints": F.when(F.size("constraints") > 0, C.sequence(ordered)),
            }
        ),
    )


def aggregate_fact_key(
    release: Column | None = None,
    series: Column | None = None,
    observed: Column | None = None,
    dimensions: Column | None = None,
    universe: Column | None = None,
) -> Column:
    """Second-generation fact key over its component keys."""
    pick = lambda given, make: make() if given is None else given
    return C.digest(
        "aggregate_fact.v2",
        C.record(
            {
                "source_release_key": pick(release, source_release_key),
                "source_series_key": pick(series, source_series_key),
                "observed_measure_key": pick(observed, observed_measure_key),
                **_aggregation(),
                **_period(),
                **_place(),
                **_entity(),
                "dimension_set_key": pick(dimensions, dimension_set_key),
                "universe_constraint_set_key": pick(universe, constraint_set_key),
                "assertion": stated_assertion(F.col("assertion")),
            }
        ),
    )


def semantic_fact_key(universe: Column | None = None) -> Column:
    """Fact identity that does not depend on the source."""
    return C.digest(
        "semantic_fact.v2",
        C.record(
            {
                "concept": F.col("measure.concept"),
                "unit": F.col("measure.unit"),
                **_aggregation(),
                **_period(),
                **_place(),
                **_entity(),
                "universe_constraint_set_key": (
                    constraint_set_key() if universe is None else universe
                ),
                "assertion": stated_assertion(F.col("assertion")),
            }
        ),
    )


def concept_alignment_key(observed: Column | None = None) -> Column:
    """Alignment key, null where the fact carries no alignment at all."""
    stated = [
        F.coalesce(F.col(f"measure.{name}"), F.lit("")) != ""
        for name in (
            "source_concept",
            "concept_relation",
            "concept_authority",
            "legal_vintage",
        )
    ]
    key = C.digest(
        "concept_alignment.v2",
        C.record(
            {
                "observed_measure_key": (
                    observed_measure_key() if observed is None else observed
                ),
                "canonical_concept": F.col("measure.concept"),
                "relation": F.col("measure.concept_relation"),
                "authority": F.col("measure.concept_authority"),
                "legal_vintage": F.col("measure.legal_vintage"),
            }
        ),
    )
    return F.when(stated[0] | stated[1] | stated[2] | stated[3], key)


def with_fact_keys(facts: DataFrame) -> DataFrame:
    """All fact keys; component keys are hashed once and reused by name."""
    parts = facts.withColumns(
        {
            "source_release_key": source_release_key(),
            "source_series_key": source_series_key(),
            "observed_measure_key": observed_measure_key(),
            "dimension_set_key": dimension_set_key(),
            "universe_constraint_set_key": constraint_set_key(),
            "legacy_fact_key": fact_key(),
        }
    )
    return parts.withColumns(
        {
            "aggregate_fact_key": aggregate_fact_key(
                F.col("source_release_key"),
                F.col("source_series_key"),
                F.col("observed_measure_key"),
                F.col("dimension_set_key"),
                F.col("universe_constraint_set_key"),
            ),
            "semantic_fact_key": semantic_fact_key(
                F.col("universe_constraint_set_key")
            ),
            "concept_alignment_key": concept_alignment_key(
                F.col("observed_measure_key")
            ),
        }
    )


def forged_keys(rows: DataFrame) -> DataFrame:
    """Rows whose stated aggregate key differs from their own content."""
    recomputed = aggregate_fact_key(
        F.col("source_release_key"),
        F.col("source_series_key"),
        F.col("observed_measure_key"),
        F.col("dimension_set_key"),
        F.col("universe_constraint_set_key"),
    )
    return rows.withColumn("recomputed_key", recomputed).filter(
        ~F.col("aggregate_fact_key").eqNullSafe(F.col("recomputed_key"))
    )


def cell_key(artifact: Column, sheet: Column, row: Column, column: Column) -> Column:
    return C.digest(
        "cell.v1",
        C.record({"artifact": artifact, "sheet": sheet, "row": row, "column": column}),
    )


def row_key(artifact: Column, sheet: Column, row: Column) -> Column:
    return C.digest(
        "row.v1", C.record({"artifact": artifact, "sheet": sheet, "row": row})
    )


def column_key(artifact: Column, sheet: Column, position: Column, name: Column) -> Column:
    return C.digest(
        "column.v1",
        C.record(
            {"artifact": artifact, "sheet": sheet, "position": position, "name": name}
        ),
    )


def row_value_key(row: Column, column: Column) -> Column:
    return C.digest("row_value.v1", C.record({"row": row, "column": column}))


def stratum_hash(constraints: Column, jurisdiction: Column) -> Column:
    """Definition hash: sorted ``variable, operator, value`` triples."""
    triples = F.array_sort(
        F.transform(
            constraints,
            lambda item: C.record(
                {name: item[name] for name in ("variable", "operator", "value")}
            ),
        )
    )
    text = C.record(
        {"jurisdiction": jurisdiction, "constraints": C.sequence(triples)},
        keep_nulls=True,
    )
    return F.substring(F.sha2(text, 256), 1, 16)


def spec_hash(
    fields: Mapping[str, Column], defaults: Mapping[str, object], guards: Column
) -> Column:
    """Hash of a spec row with default-valued fields pruned and guards sorted."""
    pruned = {
        name: F.when(~value.eqNullSafe(F.lit(defaults[name])), value)
        if name in defaults
        else value
        for name, value in fields.items()
    }
    pruned["guards"] = F.when(F.size(guards) > 0, C.sequence(F.array_sort(guards)))
    return F.substring(F.sha2(C.record(pruned), 256), 1, 24)


def artifact_key(build_id: Column, name: Column, sha256: Column) -> Column:
    return C.digest(
        "build_artifact.v1",
        C.record({"artifact_name": name, "build_id": build_id, "sha256": sha256}),
        32,
    )


def dataset_digest(rows: DataFrame, text: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Order-independent digest of a whole dataset, one row per key group.

    Equal rows are counted first, so a third of the data being one row costs
    nothing.  Row hashes are then folded in three levels by hash prefix (six
    digits, three digits, root): 16.7 million buckets keep every list short
    whatever the number of rows.
    """
    by = list(keys)
    counted = (
        rows.select(*by, F.sha2(text, 256).alias("_hash"))
        .groupBy(*by, "_hash")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .select(
            *by,
            F.col("_hash").alias("_part"),
            F.concat_ws(":", "_hash", "_copies").alias("_text"),
            F.col("_copies").alias("_rows"),
        )
    )
    for width in (6, 3, 0):
        counted = (
            counted.groupBy(*by, F.substring("_part", 1, width).alias("_part"))
            .agg(
                F.sha2(F.array_join(F.sort_array(F.collect_list("_text")), ","), 256)
                .alias("_text"),
                F.sum("_rows").alias("_rows"),
            )
        )
    return counted.select(
        *by,
        F.concat(F.lit("build.v1:"), F.substring("_text", 1, 24)).alias("digest"),
        F.col("_rows").alias("row_count"),
    )
