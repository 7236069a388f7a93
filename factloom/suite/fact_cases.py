"""Queries for fact rows: labels, constraints, flattening, consumer rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.plans import facts as P
from factloom.suite.fact_base import SQL_FACTS, SQL_KEYED, flat_facts, order_facts
from factloom.suite.registry import query

SQL_LABEL = """geography_name || ' ' || period_value || ' ' || replace(period_type, '_', ' ') || ' '
  || CASE WHEN assertion = 'source_projection' THEN 'projected ' ELSE '' END || 'sum us trade ' || lseg
  || ' for ' || replace(entity_name, '_', ' ') || ' (' || concat_ws(', ', 'agi lower usd=' || agi_lower_usd,
    'agi upper usd=' || agi_upper_usd, 'eitc child count=' || eitc_child_count, 'filing status=' || filing_status,
    'income range=' || replace(income_range, '_', ' '), 'trade region=' || trade_region) || ') [' || source_name || ' ' || source_table || ']'"""


@query(
    "fn08_fact_label",
    f"WITH {SQL_FACTS} SELECT seq, CASE WHEN st <> 'P' THEN {SQL_LABEL} END AS label FROM facts",
)
def fn08(spark, sf):
    return order_facts(spark, sf).select("seq", "label")


SQL_LIFTED = """
lifted0 AS (
  SELECT seq, 0 AS pos, 'us.age' AS variable, '>=' AS operator, '18' AS value, 'year' AS unit, 'Adult' AS label FROM facts WHERE n_explicit > 0
  UNION ALL SELECT seq, 1, 'irs_soi.filing_status', '==', filing_status, NULL, 'Filing status' FROM facts WHERE n_explicit = 0 AND filing_status <> 'all'
  UNION ALL SELECT seq, 2, 'irs_soi.adjusted_gross_income', '>=', agi_lower_usd, 'usd', 'Adjusted gross income lower bound' FROM facts WHERE n_explicit = 0 AND agi_lower_usd IS NOT NULL
  UNION ALL SELECT seq, 3, 'irs_soi.adjusted_gross_income', '<', agi_upper_usd, 'usd', 'Adjusted gross income upper bound' FROM facts WHERE n_explicit = 0 AND agi_upper_usd IS NOT NULL
  UNION ALL SELECT seq, 4, 'us.tax.earned_income_credit_qualifying_children', CASE eitc_child_count WHEN '3plus' THEN '>=' ELSE '==' END,
      replace(eitc_child_count, 'plus', ''), 'count', 'EITC qualifying children' FROM facts WHERE n_explicit = 0 AND eitc_child_count <> 'all'
  UNION ALL SELECT seq, 5, 'trade_region', '==', trade_region, NULL, 'trade region' FROM facts WHERE n_explicit = 0),
lifted AS (SELECT seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY pos) - 1 AS INTEGER) AS ordinal, variable, operator, value, unit, label FROM lifted0)"""


@query(
    "vl18_lifted_constraints",
    f"WITH {SQL_FACTS}, {SQL_LIFTED} SELECT * FROM lifted",
)
def vl18(spark, sf):
    return (
        order_facts(spark, sf)
        .select("seq", F.posexplode(P.effective_constraints()).alias("ordinal", "item"))
        .select(
            "seq",
            "ordinal",
            *[
                F.col(f"item.{name}").alias(name)
                for name in ("variable", "operator", "value", "unit", "label")
            ],
        )
    )


SQL_FILTERS_JSON = """'{' || concat_ws(',', '"filing_status":"' || filing_status || '"', '"agi_lower_usd":"' || agi_lower_usd || '"',
  '"agi_upper_usd":"' || agi_upper_usd || '"', '"eitc_child_count":"' || eitc_child_count || '"',
  '"income_range":"' || income_range || '"', '"trade_region":"' || trade_region || '"') || '}'"""


@query(
    "prj12_flatten_fact",
    f"""
    WITH {SQL_FACTS} SELECT seq, value_num, value_text, period_type, period_value, geography_level, geography_id, concept,
      source_name, source_size_bytes, measure_id, {SQL_FILTERS_JSON} AS filters_json,
      CASE WHEN st = 'F' THEN '{{"start_date":"' || y || '-01-01","basis":"calendar"}}' END AS coverage_json FROM facts""",
)
def prj12(spark, sf):
    return P.flatten_facts(order_facts(spark, sf)).select(
        "seq",
        "value_num",
        "value_text",
        "period_type",
        "period_value",
        "geography_level",
        "geography_id",
        "concept",
        "source_name",
        "source_size_bytes",
        "measure_id",
        "filters_json",
        "coverage_json",
    )


@query(
    "prj13_prune_nested",
    f"""
    WITH {SQL_FACTS} SELECT seq, '{{"seq":' || seq || CASE WHEN url IS NOT NULL THEN ',"url":"' || url || '"' ELSE '' END
      || CASE WHEN n_explicit > 0 THEN ',"variables":["us.age"]' ELSE '' END
      || CASE WHEN source_concept IS NULL AND legal_vintage IS NULL THEN '' ELSE ',"alignment":{{' || concat_ws(',',
        '"source_concept":"' || source_concept || '"', '"relation":"' || concept_relation || '"', '"legal_vintage":"' || legal_vintage || '"') || '}}' END
      || '}}' AS body FROM facts""",
)
def prj13(spark, sf):
    body = P.pruned_json(
        {
            "seq": F.col("seq"),
            "url": F.col("source.url"),
            "variables": P.none_if_empty(F.col("constraints.variable")),
        },
        {
            "alignment": {
                "source_concept": F.col("measure.source_concept"),
                "relation": F.col("measure.concept_relation"),
                "legal_vintage": F.col("measure.legal_vintage"),
            },
            "coverage_end": {"end_date": F.col("period_coverage.end_date")},
        },
    )
    return order_facts(spark, sf).select("seq", body.alias("body"))


ARTIFACT_COLUMNS = (
    "source_name",
    "source_table",
    "source_file",
    "vintage",
    "source_size_bytes",
    "raw_bucket",
    "raw_key",
    "raw_uri",
)


@query(
    "pt11_build_facts",
    f"""
    WITH {SQL_FACTS} SELECT seq, value_num, period_value, geography_id, concept, source_name, source_table, source_sha256,
      source_size_bytes, source_record_id, {SQL_LABEL} AS label, 'cell selectors resolved from cells' AS extraction_method FROM facts""",
)
def pt11(spark, sf):
    flat = flat_facts(spark, sf).withColumn("artifact_sha256", F.col("source_sha256"))
    artifacts = flat.select(
        "artifact_sha256", "source_sha256", *ARTIFACT_COLUMNS
    ).distinct()
    records = flat.drop(
        "source_sha256", "url", "extraction_method", *ARTIFACT_COLUMNS
    )
    return P.facts_from_records(records, artifacts).select(
        "seq",
        "value_num",
        F.col("period.value").alias("period_value"),
        F.col("geography.id").alias("geography_id"),
        "measure.concept",
        "source.source_name",
        "source.source_table",
        "source.source_sha256",
        "source.source_size_bytes",
        "source_record_id",
        "label",
        "source.extraction_method",
    )


@query(
    "pt12_consumer_rows",
    f"""
    WITH {SQL_FACTS}, {SQL_KEYED} SELECT 'consumer_fact.v1' AS schema_version, aggregate_fact_key, legacy_fact_key, value_text AS value, assertion,
      provenance_class, survey_instrument, coalesce(measure_id, source_concept, concept) AS source_measure_id,
      coalesce(source_concept, concept) AS observed_concept, concept_alignment_key, CASE WHEN concept_alignment_key IS NOT NULL THEN concept END AS canonical_concept,
      CAST(5 - (filing_status IS NULL)::INT - (agi_lower_usd IS NULL OR agi_upper_usd IS NULL)::INT - (eitc_child_count IS NULL)::INT + 1 AS INTEGER) AS n_dimensions,
      CAST(n_explicit AS INTEGER) AS n_constraints, source_record_id FROM keyed""",
)
def pt12(spark, sf):
    return P.consumer_rows(order_facts(spark, sf)).select(
        "schema_version",
        "aggregate_fact_key",
        "legacy_fact_key",
        "value",
        "assertion",
        "provenance_class",
        "survey_instrument",
        "observed_measure.source_measure_id",
        F.col("observed_measure.source_concept").alias("observed_concept"),
        "concept_alignment.concept_alignment_key",
        "concept_alignment.canonical_concept",
        F.size("dimensions").alias("n_dimensions"),
        F.size("universe_constraints.constraints").alias("n_constraints"),
        "lineage.source_record_id",
    )
