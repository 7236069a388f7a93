"""Snapshot tables, ordered export with manifest, upsert, prune, summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import canonical as C
from factloom.functions import keys as K
from factloom.operators.coverage import side_by_side
from factloom.operators.sequence import first_wins, join_on
from factloom.plans import facts as P

# Primary keys of the snapshot tables.
PRIMARY_KEYS = {
    "builds": ("build_id",),
    "source_artifacts": ("source_sha256",),
    "source_columns": ("column_key",),
    "source_rows": ("row_key",),
    "source_row_values": ("value_key",),
    "source_cells": ("cell_key",),
    "source_records": ("source_record_id",),
    "concept_alignments": (
        "source_concept",
        "canonical_concept",
        "relation",
        "legal_vintage",
        "period_type",
        "period_value",
    ),
    "aggregate_facts": ("fact_key",),
    "aggregate_constraints": ("fact_key", "ordinal"),
    "fact_source_cells": ("fact_key", "cell_key"),
    "fact_source_rows": ("fact_key", "row_key"),
}


def concept_alignments(facts: DataFrame) -> DataFrame:
    """Distinct alignments with the first fact of each, wide key."""
    stated = facts.filter(
        (F.col("measure.source_concept") != "")
        & (F.col("measure.concept_relation") != "")
    ).select(
        F.col("measure.source_concept").alias("source_concept"),
        F.col("measure.concept").alias("canonical_concept"),
        F.col("measure.concept_relation").alias("relation"),
        F.col("measure.legal_vintage").alias("legal_vintage"),
        F.col("period.type").alias("period_type"),
        F.col("period.value").alias("period_value"),
        F.col("measure.concept_authority").alias("authority"),
        F.col("measure.concept_evidence_url").alias("evidence_url"),
        F.col("measure.concept_evidence_notes").alias("evidence_notes"),
        "source_record_id",
        "seq",
    )
    return first_wins(stated, PRIMARY_KEYS["concept_alignments"], ["seq"])


def source_records(facts: DataFrame) -> DataFrame:
    """First fact per source record with its lineage counts."""
    rows = facts.filter(F.col("source_record_id").isNotNull()).select(
        "source_record_id",
        "seq",
        F.size("source_row_keys").alias("row_count"),
        F.size("source_cell_keys").alias("cell_count"),
    )
    return first_wins(rows, ["source_record_id"], ["seq"])


def source_artifacts(rows: DataFrame, order: str = "seq") -> DataFrame:
    """Artifacts de-duplicated by checksum, first seen wins."""
    names = [name for name in P.FACT_GROUPS["source"] if name != "source_sha256"]
    flat = rows.select(order, *[F.col(f"source.{n}").alias(n) for n in ("source_sha256", *names)])
    return first_wins(flat, ["source_sha256"], [order])


def snapshot(facts: DataFrame, rows: DataFrame, values: DataFrame, cells: DataFrame):
    """The linked tables of one build, by name, as DataFrames.

    ``facts`` carry ``seq``; ``rows``, ``values`` and ``cells`` carry their own
    keys.  Keys are hashed once; persist the inputs when several tables are
    written from them.
    """
    keyed = facts.withColumn("fact_key", K.fact_key())
    flat = P.flatten_facts(keyed.drop("source_row_keys", "source_cell_keys"))
    constraints = keyed.select(
        "fact_key", F.posexplode(P.effective_constraints()).alias("ordinal", "item")
    ).select("fact_key", "ordinal", "item.*")
    content = C.record(
        {"fact_key": F.col("fact_key"), "value": F.col("value_text"), "label": F.col("label")}
    )
    build = K.dataset_digest(keyed, content).withColumnsRenamed(
        {"digest": "build_id", "row_count": "facts_count"}
    )
    columns = values.groupBy("column_key").agg(
        F.min("position").alias("position"), F.min("raw_name").alias("raw_name")
    )
    return {
        "builds": build,
        "source_artifacts": source_artifacts(facts),
        "source_columns": columns,
        "source_rows": rows,
        "source_row_values": values,
        "source_cells": cells,
        "source_records": source_records(facts),
        "concept_alignments": concept_alignments(facts),
        "aggregate_facts": flat,
        "aggregate_constraints": constraints,
        "fact_source_cells": keyed.select(
            "fact_key", F.posexplode("source_cell_keys").alias("ordinal", "cell_key")
        ),
        "fact_source_rows": keyed.select(
            "fact_key", F.posexplode("source_row_keys").alias("ordinal", "row_key")
        ),
    }


def write_snapshot(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, frame in tables.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")


def export_tables(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], folder: str
) -> DataFrame:
    """Write each table as JSON lines in key order; return the manifest."""
    for name, frame in tables.items():
        ordered = frame.orderBy(*keys[name])
        ordered.write.mode("overwrite").json(f"{folder}/{name}")
    return manifest(tables)


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count, digest`` of each table, as one plan."""
    result = None
    for name, frame in tables.items():
        text = F.to_json(F.struct(*sorted(frame.columns)))
        part = K.dataset_digest(frame, text).withColumn("table_name", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result.select("table_name", "row_count", "digest")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` replace the rows of ``target`` with the same key.

    Null key parts are equal.
    """
    kept = join_on(target, source.select(*keys), keys, "left_anti")
    return kept.unionByName(source)


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dry run: how many rows would be inserted and updated."""
    known = target.select(*keys).withColumn("_known", F.lit(True))
    marked = join_on(source.select(*keys), known, keys)
    return marked.agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"),
        F.count_if(F.col("_known").isNotNull()).alias("updated"),
    )


def replace_scope(
    stored: DataFrame, loaded: DataFrame, slug: str, scope: Sequence[str]
) -> DataFrame:
    """Replace entries by slug and prune entries of a loaded scope not loaded."""
    scopes = loaded.select(*scope).distinct()
    outside = stored.join(scopes, list(scope), "left_anti")
    kept = outside.join(loaded.select(slug), slug, "left_anti")
    return kept.unionByName(loaded)


def nested_summary(parts: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row with one JSON array per report.

    For small reports only: each part has one row per source, year or area.
    """
    return side_by_side(
        [
            frame.agg(F.to_json(F.array_sort(F.collect_list(row))).alias(name))
            for name, (frame, row) in parts.items()
        ]
    )
