"""Queries for the evidence check and the acceptance gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import coverage as V
from factloom.operators import selectors as L
from factloom.plans import evidence as E
from factloom.plans import facts as P
from factloom.plans import rules as PRU
from factloom.session import materialise
from factloom.sources import store as T
from factloom.suite.fact_base import SQL_FACTS, flat_facts
from factloom.suite.issue_cases import is_status
from factloom.suite.registry import query, table


#: What the evidence check and its source rows need of a fact.
JUDGED = "seq value_num period geography entity source filters constraints source_row_keys source_cell_keys".split()


def evidence_tables(spark, sf, columns=("*",)):
    """Facts, source row values and header cells, all from the same orders."""
    flat = flat_facts(spark, sf)
    key = F.col("seq").cast("string")
    facts = P.nest_facts(
        flat.withColumns(
            {"source_row_keys": F.array(key), "source_cell_keys": F.array(key)}
        )
    )
    facts = materialise(facts.select(*columns), "evidence-facts")
    segment, price = F.col("source.source_name"), F.col("value_num")
    kind = F.col("entity.name")
    year = F.col("source.vintage").cast("int")
    regional = segment != "bureau_machinery"
    own = segment == "bureau_household"
    region = F.col("filters")["trade_region"]

    def value(position, name, text, test=None):
        item = F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("raw_name"),
            text.cast("string").alias("value_text"),
        )
        return item if test is None else F.when(test, item)

    values = F.array_compact(
        F.array(
            value(1, "Period", F.when(kind == "household", year + 1).otherwise(year)),
            value(
                2,
                "AGI_STUB",
                F.when(price < 100000, "6").when(price < 300000, "8").otherwise("10"),
            ),
            value(
                3,
                "Trade Region",
                F.when(segment == "bureau_building", "RX").otherwise(region),
                regional,
            ),
            value(
                4,
                "Age",
                F.when(is_status("F"), "Aged 18-24")
                .when(is_status("O") & (kind != "person"), "18")
                .otherwise("Adult"),
            ),
            value(5, "filing status", F.lit("single")),
            value(
                6,
                "AdjustedGrossIncome lower",
                F.lit("100,000"),
                segment == "bureau_furniture",
            ),
            value(7, "agi_lower_usd", F.col("filters")["agi_lower_usd"], own),
            value(8, "agi_upper_usd", F.col("filters")["agi_upper_usd"], own),
        )
    )
    row_values = facts.select(
        F.col("source_row_keys")[0].alias("row_key"), F.inline(values)
    )
    header = F.when(kind == "household", "n59662 ").when(kind == "tax_unit", "N59664")
    cells = facts.select(
        F.col("source_cell_keys")[0].alias("cell_key"),
        header.alias("raw"),
        F.lit(None).cast("string").alias("display"),
    )
    return facts, row_values, cells


SQL_EVIDENCE = """
ev AS (
  SELECT seq, 'period' AS kind, 'period' AS variable, 'fact_period_not_evidenced_by_source_row' AS code, 1::BIGINT AS mismatches FROM facts WHERE st = 'P' OR pr = '1'
  UNION ALL SELECT seq, 'filter', 'agi_lower_usd', 'row_filter_not_evidenced', 0 FROM facts WHERE agi_lower_usd IS NOT NULL AND seg <> 'HOUSEHOLD'
  UNION ALL SELECT seq, 'filter', 'agi_upper_usd', 'row_filter_not_evidenced', 0 FROM facts WHERE agi_upper_usd IS NOT NULL AND seg <> 'HOUSEHOLD'
  UNION ALL SELECT seq, 'filter', 'eitc_child_count', 'row_filter_not_evidenced', 0 FROM facts WHERE pr = '2'
  UNION ALL SELECT seq, 'filter', 'income_range', 'row_filter_value_mismatch', 1 FROM facts WHERE income_range = '100k_to_300k'
  UNION ALL SELECT seq, 'filter', 'trade_region', 'row_filter_not_evidenced', 0 FROM facts WHERE seg = 'MACHINERY'
  UNION ALL SELECT seq, 'filter', 'trade_region', 'row_filter_value_mismatch', 1 FROM facts WHERE seg = 'BUILDING'
  UNION ALL SELECT seq, 'constraint', 'us.age', 'row_constraint_value_mismatch', 1 FROM facts WHERE st = 'O' AND pr = '2'
  UNION ALL SELECT seq, 'constraint', 'irs_soi.adjusted_gross_income', 'row_constraint_not_evidenced', 0 FROM facts WHERE st <> 'O' AND agi_lower_usd IS NOT NULL AND NOT (seg = 'FURNITURE' AND agi_lower_usd = '100000')
  UNION ALL SELECT seq, 'constraint', 'irs_soi.adjusted_gross_income', 'row_constraint_not_evidenced', 0 FROM facts WHERE st <> 'O' AND agi_upper_usd = '300000'
  UNION ALL SELECT seq, 'constraint', 'us.tax.earned_income_credit_qualifying_children', 'row_constraint_not_evidenced', 0 FROM facts WHERE st <> 'O' AND pr = '2'
  UNION ALL SELECT seq, 'constraint', 'trade_region', 'row_constraint_not_evidenced', 0 FROM facts WHERE st <> 'O' AND seg = 'MACHINERY'
  UNION ALL SELECT seq, 'constraint', 'trade_region', 'row_constraint_value_mismatch', 1 FROM facts WHERE st <> 'O' AND seg = 'BUILDING')"""


@query("vl11_evidence", f"WITH {SQL_FACTS}, {SQL_EVIDENCE} SELECT * FROM ev")
def vl11(spark, sf):
    facts, row_values, cells = evidence_tables(spark, sf, JUDGED)
    return E.evidence_issues(facts, "seq", row_values, cells).drop("claim")


@query(
    "vl11_evidence_of_pairs",
    f"""
    WITH {SQL_FACTS}, {SQL_EVIDENCE}
    SELECT seq, kind, variable, code, mismatches * 2 AS mismatches FROM ev
    UNION ALL SELECT seq, 'filter', 'trade_region', 'row_filter_value_mismatch', 1 FROM facts WHERE seg = 'AUTOMOBILE'
    UNION ALL SELECT seq, 'constraint', 'trade_region', 'row_constraint_value_mismatch', 1 FROM facts WHERE st <> 'O' AND seg = 'AUTOMOBILE'""",
)
def vl11_pairs(spark, sf):
    """Two rows and two cells per fact; the second row of one source disagrees."""
    facts, row_values, cells = evidence_tables(spark, sf, JUDGED)
    key = F.col("seq").cast("string")
    mark = F.when(F.col("source.source_name") == "bureau_automobile", F.lit("x")).otherwise(F.lit("y"))
    second = F.concat(mark, key)
    facts = facts.withColumns(
        {"source_row_keys": F.array(key, second), "source_cell_keys": F.array(second, key)}
    )
    wrong = (F.col("copy_key").startswith("x")) & (F.col("raw_name") == "Trade Region")
    copies = row_values.withColumn("copy_key", F.explode(F.array(*[F.concat(F.lit(m), "row_key") for m in "xy"])))
    copies = copies.select(
        F.col("copy_key").alias("row_key"),
        "position",
        "raw_name",
        F.when(wrong, "RY").otherwise(F.col("value_text")).alias("value_text"),
    )
    plain = cells.select(
        F.explode(F.array(*[F.concat(F.lit(m), "cell_key") for m in "xy"])).alias("cell_key"),
        F.lit("header").alias("raw"),
        "display",
    )
    return E.evidence_issues(
        facts, "seq", row_values.unionByName(copies), cells.unionByName(plain)
    ).drop("claim")


SQL_GATE = f"""
    WITH {SQL_FACTS}, {SQL_EVIDENCE},
    dup AS (SELECT 1 AS one FROM facts GROUP BY period_type, period_value, geography_level, geography_id, st, entity_name, seg, y, assertion,
      filing_status, agi_lower_usd, agi_upper_usd, eitc_child_count, income_range, trade_region HAVING count(*) > 1)
    SELECT (SELECT count(DISTINCT source_sha256) FROM facts) AS raw_artifact_count, (SELECT count(DISTINCT source_sha256) FROM facts) AS raw_link_count,
      count(*) AS source_row_count, count(*) AS source_cell_count, count(*) AS fact_count, 0::BIGINT AS missing_lineage_count, 0::BIGINT AS missing_source_row_lineage_count,
      count(*) FILTER (pr IN ('3', '5')) AS expected_constraint_fact_count, count(*) FILTER (pr IN ('3', '5')) AS constrained_expected_fact_count,
      (SELECT count(*) FROM dup) AS fact_error_count, 0::BIGINT AS missing_provenance_count, count(*) FILTER (seg = 'MACHINERY') AS unresolved_source_row_lineage_count,
      (SELECT CAST(sum(greatest(mismatches, 1)) AS BIGINT) FROM ev WHERE seq NOT IN (SELECT seq FROM facts WHERE seg = 'MACHINERY')) AS row_semantic_error_count,
      count(*) FILTER (st <> 'P') AS source_record_count, count(*) FILTER (st <> 'P') AS source_record_lineaged_count,
      (SELECT count(*) FROM (SELECT DISTINCT source_concept, concept, concept_relation, legal_vintage FROM facts WHERE source_concept IS NOT NULL)) AS concept_alignment_count,
      (SELECT count(*) FROM (SELECT arg_min(coalesce(concept_evidence_url, ''), seq) AS u FROM facts WHERE concept_relation = 'exact' GROUP BY source_concept, concept, legal_vintage) WHERE u = '') AS concept_alignment_missing_evidence_count,
      (SELECT count(*) FROM dup) = 0 AS stage_reports_valid, true AS raw_artifacts_linked, true AS full_source_document_parsed, true AS facts_have_provenance,
      true AS facts_have_source_cell_lineage, false AS facts_have_source_row_lineage, false AS row_lineage_semantics_evidenced, true AS expected_constraints_present,
      false AS concept_alignments_have_evidence, false AS accepted FROM facts"""


@query("vl10_acceptance_gate", SQL_GATE)
def vl10(spark, sf):
    return gate(spark, sf)


@query(
    "vl10_full_gate",
    SQL_GATE.replace(
        "false AS accepted FROM facts",
        """false AS accepted,
      count(DISTINCT seg) FILTER (seg = 'MACHINERY') AS selected_row_parse_count,
      (SELECT count(*) FROM al WHERE concept IN ('us.trade.building', 'us.trade.automobile', 'us.trade.furniture')) AS concept_alignment_checked_count,
      (SELECT count(*) FROM al WHERE concept = 'us.trade.household') AS concept_alignment_unchecked_count,
      (SELECT count(*) FROM al WHERE concept = 'us.trade.furniture') AS concept_alignment_invalid_count,
      false AS selected_row_only_parser_not_used, false AS concept_alignments_resolve, false AS required_concept_alignments_validated FROM facts""",
    ).replace(
        "dup AS (",
        "al AS (SELECT DISTINCT source_concept, concept, concept_relation, legal_vintage FROM facts WHERE source_concept IS NOT NULL), dup AS (",
    ),
)
def vl10_full(spark, sf):
    segments = table(spark, sf, "customer").select("c_mktsegment").distinct()
    parsers = segments.select(
        F.when(F.col("c_mktsegment") == "MACHINERY", E.SELECTED_ROWS_PARSER).otherwise("delimited_text").alias("parser")
    )
    registry = segments.filter("c_mktsegment != 'HOUSEHOLD'").select(
        F.concat(F.lit("us.trade."), F.lower("c_mktsegment")).alias("concept"),
        (F.col("c_mktsegment") != "FURNITURE").alias("valid"),
    )
    return gate(spark, sf, parsers=parsers, registry=registry, require_validation=True)


def gate(spark, sf, **more):
    facts, row_values, cells = evidence_tables(spark, sf)
    source_rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("row_key")
    )
    known = facts.filter("source.source_name != 'bureau_machinery'").select(
        F.col("source_row_keys")[0].alias("row_key")
    )
    unresolved = L.resolve_lineage(facts, "seq", "source_row_keys", known, "row_key")
    records = facts.select(
        (F.col("period.type") != "month").alias("resolved"),
        F.size("source_cell_keys").alias("lineage_count"),
    )
    labelled = facts.withColumn("label", P.fact_label())
    constrained = (F.size("constraints") > 0) | (
        F.size(P.filter_constraints(F.col("filters"))) > 0
    )
    dimension = F.coalesce("layout.groupby_dimension", F.lit("geography"))
    expected = (dimension != "geography") & (F.col("layout.table_record_kind") != "total")
    return E.acceptance(
        T.source_artifacts(facts),
        source_rows,
        cells,
        facts,
        records,
        V.distinct_alignments(facts),
        PRU.validate_facts(labelled),
        E.evidence_issues(facts, "seq", row_values, cells),
        unresolved.filter("issue = 'unresolved_lineage'"),
        expected,
        constrained,
        **more,
    )
