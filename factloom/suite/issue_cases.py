"""Queries for the validation rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import keys as K
from factloom.operators import issues as I
from factloom.operators import selectors as L
from factloom.plans import facts as P
from factloom.plans import rules as PRU
from factloom.plans import schema as PS
from factloom.session import materialise
from factloom.suite.fact_base import SQL_FACTS, SQL_KEYED, order_facts
from factloom.suite.registry import query, sql_digest, sql_record, table
from factloom.suite.reshape_cases import spec_tables
from factloom.suite.selector_cases import order_guards, part_cells


def is_status(status):
    """Order status behind a fact of the shared fact table."""
    if status == "P":
        return F.col("period.type") == "month"
    final = (F.col("period.type") != "month") & F.col("geography.vintage").isNull()
    if status == "F":
        return final
    return (F.col("period.type") != "month") & F.col("geography.vintage").isNotNull()


def spoiled_facts(spark, sf):
    """The shared facts with one defect per rule, chosen by their content."""
    facts = order_facts(spark, sf).withColumns(
        {
            "_st": F.when(is_status("P"), "P").when(is_status("F"), "F").otherwise("O"),
            "_pr": F.col("entity.name"),
            "_seg": F.col("source.source_name"),
            "_y": F.col("source.vintage"),
        }
    )
    st, pr, seg, y = F.col("_st"), F.col("_pr"), F.col("_seg"), F.col("_y")

    def spoil(group, field, test, value):
        kept = F.col(f"{group}.{field}")
        return F.col(group).withField(field, F.when(test, value).otherwise(kept))

    final = st == "F"
    facts = facts.withColumns(
        {
            "period": spoil("period", "type", (seg == "bureau_machinery") & (st == "P"), "week"),
            "geography": spoil("geography", "level", F.col("filters")["trade_region"] == "R4", "planet"),
            "entity": spoil("entity", "name", (pr == "family") & (st == "O"), F.lit(None)),
            "survey_instrument": F.when((pr == "return") & final, F.lit(None))
            .when((pr == "household") & final, "x")
            .otherwise(F.col("survey_instrument")),
            "measure": spoil("measure", "concept_relation", (seg == "bureau_building") & (st == "O"), F.lit(None)),
            "value_type": F.when((pr == "person") & (st == "P"), "boolean").otherwise(F.col("value_type")),
            "constraints": F.when(
                (pr == "tax_unit") & (st == "O"),
                F.transform("constraints", lambda item: item.withField("operator", F.lit("~"))),
            ).otherwise(F.col("constraints")),
            "source": spoil("source", "vintage", y == "1999", " "),
            "period_coverage": F.when(
                final & (y == "1995"),
                F.col("period_coverage").withField("start_date", F.lit("1995-13-01")),
            )
            .when(
                final & (y == "1996"),
                F.col("period_coverage").withField("end_date", F.lit("1990-01-01")),
            )
            .otherwise(F.col("period_coverage")),
        }
    )
    return facts.drop("_st", "_pr", "_seg", "_y")


@query(
    "vl01_fact_rules",
    f"""
    WITH {SQL_FACTS}, bad AS (SELECT *, CASE WHEN seg = 'MACHINERY' AND st = 'P' THEN 'week' ELSE period_type END AS pt,
        CASE WHEN n_regionkey = 4 THEN 'planet' ELSE geography_level END AS gl, CASE WHEN pr = '4' AND st = 'O' THEN NULL ELSE entity_name END AS en,
        CASE WHEN seg = 'BUILDING' AND st = 'O' THEN NULL ELSE concept_relation END AS rel, pr = '3' AND st = 'O' AS tilde FROM facts),
    i AS (
      SELECT seq, 'malformed_period' AS code, 'period.type' AS field, 'error' AS severity FROM bad WHERE pt = 'week'
      UNION ALL SELECT seq, 'malformed_geography', 'geography.level', 'error' FROM bad WHERE gl = 'planet'
      UNION ALL SELECT seq, 'malformed_entity', 'entity.name', 'error' FROM bad WHERE en IS NULL
      UNION ALL SELECT seq, 'missing_survey_instrument', 'survey_instrument', 'error' FROM bad WHERE pr = '5' AND st = 'F'
      UNION ALL SELECT seq, 'misplaced_survey_instrument', 'survey_instrument', 'error' FROM bad WHERE pr = '1' AND st = 'F'
      UNION ALL SELECT seq, 'missing_field', 'measure.concept_relation', 'error' FROM bad WHERE seg = 'BUILDING' AND st = 'O'
      UNION ALL SELECT seq, 'malformed_value', 'value', 'error' FROM bad WHERE pr = '2' AND st = 'P'
      UNION ALL SELECT seq, 'malformed_constraint', 'constraints.0.operator', 'error' FROM bad WHERE tilde
      UNION ALL SELECT seq, 'missing_field', 'source.vintage', 'error' FROM bad WHERE y = 1999
      UNION ALL SELECT seq, 'malformed_period_coverage', 'period_coverage.start_date', 'error' FROM bad WHERE st = 'F' AND y IN (1995, 1996)
      UNION ALL SELECT seq, 'missing_label', 'label', 'warning' FROM bad WHERE st = 'P'
      UNION ALL SELECT min(seq), 'duplicate_key', NULL, 'error' FROM bad GROUP BY pt, period_value, gl, geography_id, st, en, seg, rel, y, assertion, tilde,
        filing_status, agi_lower_usd, agi_upper_usd, eitc_child_count, income_range, trade_region HAVING count(*) > 1)
    SELECT * FROM i""",
)
def vl01(spark, sf):
    facts = materialise(spoiled_facts(spark, sf), "spoiled-facts")
    return PRU.validate_facts(facts).drop("fact_key")


_RK = sql_digest(
    "row.v1",
    sql_record({"artifact": "sha256('x')", "sheet": "o_orderpriority", "row": "o_custkey"}),
)


@query(
    "vl02_row_rules",
    f"""
    WITH r AS (SELECT o_orderkey AS row_index, {_RK} AS row_key, * FROM orders)
    SELECT row_index, row_key, 'missing_source_name' AS code FROM r WHERE o_orderstatus = 'P' AND o_totalprice > 400000
    UNION ALL SELECT row_index, row_key, 'missing_artifact_sha256' FROM r WHERE o_orderstatus = 'F' AND o_totalprice > 450000
    UNION ALL SELECT row_index, row_key, 'malformed_coordinate' FROM r WHERE o_custkey = 0
    UNION ALL SELECT row_index, row_key, 'missing_values' FROM r WHERE o_totalprice < 5000
    UNION ALL SELECT min(row_index), row_key, 'duplicate_source_row_key' FROM r GROUP BY row_key HAVING count(*) > 1""",
)
def vl02(spark, sf):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_index"),
        K.row_key(
            F.sha2(F.lit("x"), 256), F.col("o_orderpriority"), F.col("o_custkey")
        ).alias("row_key"),
        F.when((status == "P") & (price > 400000), " ").otherwise("orders").alias("source_name"),
        F.when(~((status == "F") & (price > 450000)), "x").alias("sha256"),
        F.col("o_custkey").alias("row_number"),
        F.when(price < 5000, 0).otherwise(4).alias("value_count"),
    )
    return PRU.validate_rows(rows, "row_key", "row_index")


@query(
    "vl03_cell_rules",
    """
    WITH c AS (SELECT p_partkey * 10 + pos AS cell_index, p_brand || '-' || p_size || '-' || pos AS cell_key, p_size, p_type, pos FROM part, range(0, 4) t(pos))
    SELECT cell_index, cell_key, 'missing_source_name' AS code FROM c WHERE p_type = 'PROMO' AND pos = 3
    UNION ALL SELECT cell_index, cell_key, 'missing_artifact_sha256' FROM c WHERE p_type = 'SMALL' AND p_size > 40
    UNION ALL SELECT cell_index, cell_key, 'malformed_coordinate' FROM c WHERE pos = 0
    UNION ALL SELECT min(cell_index), cell_key, 'duplicate_source_cell_key' FROM c GROUP BY cell_key HAVING count(*) > 1""",
)
def vl03(spark, sf):
    kind, size, position = F.col("p_type"), F.col("p_size"), F.col("column_number")
    cells = (
        table(spark, sf, "part")
        .withColumn("column_number", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .select(
            (F.col("p_partkey") * 10 + position).alias("cell_index"),
            F.concat_ws("-", "p_brand", size, position).alias("cell_key"),
            F.when((kind == "PROMO") & (position == 3), "").otherwise("part").alias("source_name"),
            F.when(~((kind == "SMALL") & (size > 40)), "x").alias("sha256"),
            size.alias("row_number"),
            "column_number",
        )
    )
    return PRU.validate_cells(cells, "cell_key", "cell_index")


def contract_facts(spark, sf):
    """Facts that carry lifted constraints, with contract defects."""
    facts = order_facts(spark, sf)
    segment, kind = F.col("source.source_name"), F.col("entity.name")
    lifted = P.filter_constraints(F.col("filters"))
    return facts.withColumns(
        {
            "constraints": F.when(is_status("F"), lifted).otherwise(F.col("constraints")),
            "source": F.when(
                segment == "bureau_building",
                F.col("source").withField("source_file", F.lit("")),
            )
            .when(
                segment == "bureau_machinery",
                F.col("source").withField("raw_key", F.lit("derived/x")),
            )
            .otherwise(F.col("source")),
            "source_record_id": F.when(kind != "person", F.col("source_record_id")),
        }
    )


SQL_CONTRACT = """
  SELECT seq, 'implicit_constraints_from_filters' AS code, 'constraints' AS field FROM facts WHERE st = 'P'
  UNION ALL SELECT seq, 'missing_contract_provenance', 'source.source_file' FROM facts WHERE seg = 'BUILDING'
  UNION ALL SELECT seq, 'derived_fact_provenance', 'source' FROM facts WHERE seg = 'MACHINERY'
  UNION ALL SELECT seq, 'missing_contract_lineage', 'source_record_id' FROM facts WHERE pr = '2'
  UNION ALL SELECT seq, 'constraint_filter_mismatch', 'constraints' FROM (
    SELECT seq, unnest(range(0, (agi_lower_usd IS NOT NULL)::INT + (agi_upper_usd IS NOT NULL)::INT + coalesce((eitc_child_count <> 'all')::INT, 0) + 1)) FROM facts WHERE st = 'O')"""


@query(
    "vl04_contract_rules",
    f"WITH {SQL_FACTS} {SQL_CONTRACT}",
)
def vl04(spark, sf):
    return PRU.validate_contract(contract_facts(spark, sf))


@query(
    "vl04_canonical_variables",
    f"""
    WITH {SQL_FACTS}
    SELECT seq, 'constraint_filter_mismatch' AS code, 'constraints' AS field FROM facts WHERE st = 'O' AND pr IN ('2', '3', '5')
    UNION ALL SELECT seq, 'source_specific_constraint_variable', 'constraints' FROM facts WHERE st = 'O'""",
)
def vl04_canonical(spark, sf):
    # The only filter uses the source's own name space, as does the constraint.
    own = F.concat(F.col("source.source_name"), F.lit(":trade_region"))
    region = F.col("filters")["trade_region"]
    facts = (
        order_facts(spark, sf)
        .filter(is_status("O"))
        .withColumns(
            {
                "filters": F.create_map(own, region),
                "constraints": F.array(P.constraint(own, "==", region, label="x")),
            }
        )
    )
    rules, more = PRU.contract_issues(["factloom"], ["store://derived/"])
    named = [r for r in rules if r.field == "constraints"]
    return I.issue_rows(PRU.with_contract_columns(facts), ["seq"], named, more)


REQUIRED = ["key", "value", "assertion", "place"]


@query(
    "vl05_row_schema",
    """
    SELECT o_orderkey, 'malformed_key' AS code, 'key' AS field FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_orderkey, 'missing_field', 'value' FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'not_in_enumeration', 'assertion' FROM orders WHERE o_orderpriority = '2-HIGH'
    UNION ALL SELECT o_orderkey, 'unknown_field', 'extra' FROM orders WHERE o_totalprice > 300000
    UNION ALL SELECT o_orderkey, 'not_an_object', 'place' FROM orders WHERE o_orderpriority = '3-MEDIUM'
    UNION ALL SELECT o_orderkey, 'missing_survey_instrument', 'survey_instrument' FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'misplaced_survey_instrument', 'survey_instrument' FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'""",
)
def vl05(spark, sf):
    return PRU.validate_json_rows(
        json_rows(spark, sf),
        ["o_orderkey"],
        "body",
        REQUIRED,
        ["provenance_class", "survey_instrument"],
        {"key": "fact.v1"},
        {"assertion": PRU.ASSERTIONS},
        ["place"],
    )


def json_rows(spark, sf):
    level, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    survey = level == "5-LOW"
    key = F.concat(
        F.when(level == "1-URGENT", "fact.v2:").otherwise("fact.v1:"),
        F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 24),
    )
    named = F.when(status == "F", level == "4-NOT SPECIFIED").otherwise(survey)
    body = F.struct(
        key.alias("key"),
        F.when(status != "P", F.col("o_totalprice")).alias("value"),
        F.when(level == "2-HIGH", "guess").otherwise("observation").alias("assertion"),
        F.when(level != "3-MEDIUM", F.struct(status.alias("id"))).alias("place"),
        F.when(F.col("o_totalprice") > 300000, 1).alias("extra"),
        F.when(survey, "survey_aggregate").otherwise("census").alias("provenance_class"),
        F.when(named, "panel").alias("survey_instrument"),
    )
    text = F.to_json(body)
    listed = F.regexp_replace(text, r"\}$", ',"place":[1]}')
    return table(spark, sf, "orders", heavy=True).select(
        "o_orderkey", F.when(level == "3-MEDIUM", listed).otherwise(text).alias("body")
    )


@query(
    "vl05_first_error",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'assertion' WHEN o_totalprice > 300000 THEN 'extra' WHEN o_orderpriority = '1-URGENT' THEN 'key' WHEN o_orderpriority = '3-MEDIUM' THEN 'place'
      WHEN o_orderstatus = 'F' AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'survey_instrument' ELSE 'value' END AS field
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') OR o_totalprice > 300000 OR o_orderstatus IN ('P', 'F')""",
)
def vl05_first(spark, sf):
    return I.first_error(vl05(spark, sf), ["o_orderkey"]).drop("code")


#: One way to spoil a contract row: text to replace, its new text, the error.
SPOILED = [
    ('"schema_version":"consumer_fact.v1"', '"schema_version":"consumer_fact.v9"', "schema_version", "const"),
    ('"value":7.5', '"value":null', "value", "type"),
    ('"value":1997', '"value":1997.5', "period/value", "type"),
    ('"type":"calendar_year"', '"type":"calendar_year","x":1', "period", "additionalProperties"),
    ('"id":"g1"', '"id":1', "geography/id", "type"),
    ('"name":"household"', '"role":"r"', "entity", "required"),
    ('{"method":"sum"}', '["sum"]', "aggregation", "type"),
    ('"dimensions":{"a":"b"}', '"dimensions":{"a":{"b":1}}', "dimensions/a", "type"),
    ('"operator":"<",', "", "universe_constraints/constraints/1", "required"),
    ('"value":"low"', '"value":null', "universe_constraints/constraints/0/value", "type"),
    ('"source_size_bytes":11', '"source_size_bytes":"11"', "source/source_size_bytes", "type"),
    ('"c2"', "2", "lineage/source_cell_keys/1", "type"),
    ("concept_alignment.v2:", "concept_alignment.v3:", "concept_alignment/concept_alignment_key", "pattern"),
    ('"basis":"tax"', '"basis":"taxes"', "period_coverage/basis", "enum"),
    ('"provenance_class":"census"', '"provenance_class":"survey_aggregate"', "<root>", "required"),
    ('"provenance_class":"census"', '"provenance_class":"census","survey_instrument":"s"', "<root>", "not"),
    ('"provenance_class":"census"', '"provenance_class":"survey_aggregate","survey_instrument":" "', "survey_instrument", "pattern"),
    ('"label":"l"}', '"label":"l"', "<root>", "not_json"),
    ('"value_type":"number"', '"value_type":"numeric"', "value_type", "enum"),
    ('"label":"l"', '"label":"l","extra":{}', "<root>", "additionalProperties"),
]


@query(
    "vl05_nested_schema",
    "WITH s(i, location, rule) AS (VALUES "
    + ", ".join(f"({i}, '{location}', '{rule}')" for i, (_, _, location, rule) in enumerate(SPOILED, 1))
    + f") SELECT o_orderkey, location, rule FROM orders JOIN s ON o_orderkey % {len(SPOILED) + 1} = i",
)
def vl05_nested(spark, sf):
    digest = F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 24)
    keyed = lambda space: F.concat(F.lit(f"{space}:"), digest)
    words = lambda **fields: F.struct(*[F.lit(v).alias(k) for k, v in fields.items()])
    terms = F.array(
        words(variable="a", operator=">", value="low", role="filter"),
        words(variable="b", operator="<", value="high", role="filter"),
    )
    source = {name: "s" for name in PS.SOURCE_TEXTS} | {"source_size_bytes": 11, "more": True}
    body = {
        "schema_version": F.lit("consumer_fact.v1"),
        **{name: keyed(space) for name, space in PRU.ROW_KEY_SPACES.items()},
        "value": F.lit(7.5),
        "value_type": F.lit("number"),
        "assertion": F.lit("observation"),
        "provenance_class": F.lit("census"),
        "period": words(type="calendar_year", value=1997),
        "period_coverage": words(basis="tax", accounting_basis="cash"),
        "geography": words(level="state", id="g1"),
        "entity": words(name="household"),
        "aggregation": words(method="sum"),
        "observed_measure": words(source_name="s", source_table="t", source_measure_id="m", source_concept="c", unit="u"),
        "dimensions": F.create_map(F.lit("a"), F.lit("b")),
        "universe_constraints": F.struct(F.lit("d").alias("domain"), terms.alias("constraints")),
        "source": words(**source),
        "lineage": F.struct(F.lit("r").alias("source_record_id"), F.array(F.lit("c1"), F.lit("c2")).alias("source_cell_keys")),
        "concept_alignment": F.struct(
            keyed("concept_alignment.v2").alias("concept_alignment_key"),
            *[F.lit("x").alias(n) for n in ("source_concept", "canonical_concept", "relation", "authority")],
        ),
        "label": F.lit("l"),
    }
    text = F.to_json(F.struct(*[column.alias(name) for name, column in body.items()]))
    spoil = F.array(*[words(old=old, new=new) for old, new, _, _ in SPOILED])
    how = F.get(spoil, (F.col("o_orderkey") % (len(SPOILED) + 1) - 1).cast("int"))
    lines = table(spark, sf, "orders", heavy=True).select("o_orderkey", text.alias("text"), how.alias("how"))
    lines = lines.withColumn(
        "text", F.when(F.col("how").isNull(), F.col("text")).otherwise(F.replace("text", F.col("how.old"), F.col("how.new")))
    )
    return PS.first_schema_error(lines, ["o_orderkey"], "text", PS.contract_row_schema()).drop("detail")


@query(
    "vl06_non_finite",
    "SELECT event_id FROM events WHERE event_type IN ('error', 'signup', 'view')",
)
def vl06(spark, sf):
    kind = F.col("event_type")
    token = (
        F.when(kind == "error", '{"a": [1, {"b": -Infinity}]}')
        .when(kind == "signup", '{"a": NaN}')
        .when(kind == "view", '{"a": 1e999}')
        .when(kind == "click", '{"a": "NaN \\"Infinity 1e999"}')
        .otherwise(F.concat(F.lit('{"a": '), F.col("value").cast("string"), F.lit("e3}")))
    )
    return (
        table(spark, sf, "events")
        .select("event_id", token.alias("body"))
        .filter(PRU.non_finite_text(F.col("body")))
        .select("event_id")
    )


@query(
    "vl07_survey_rule",
    f"""
    WITH {SQL_FACTS}
    SELECT seq, 'missing_survey_instrument' AS code, 'survey_instrument' AS field FROM facts WHERE pr = '5' AND st = 'F'
    UNION ALL SELECT seq, 'misplaced_survey_instrument', 'survey_instrument' FROM facts WHERE pr = '1' AND st = 'F'""",
)
def vl07(spark, sf):
    rules = PRU.survey_rules(F.col("provenance_class"), F.col("survey_instrument"))
    return I.issue_rows(spoiled_facts(spark, sf), ["seq"], rules)


@query(
    "vl08_record_report",
    """
    WITH j AS (SELECT o_orderkey AS record_id, o_orderpriority, o_orderstatus, p_partkey, p_size, p_type FROM orders LEFT JOIN part ON o_custkey * 2 = p_partkey)
    SELECT record_id, CAST(CASE WHEN p_partkey IS NOT NULL AND p_type <> 'PROMO' THEN 1 ELSE 0 END AS BIGINT) AS value_cells,
      CASE WHEN p_partkey IS NULL OR p_type = 'PROMO' THEN 'selector_did_not_match'
        WHEN o_orderpriority <> '5-LOW' AND o_orderstatus = 'P' THEN 'guard_mismatch'
        WHEN p_size <> CAST(substr(o_orderpriority, 1, 1) AS INT) THEN 'guard_mismatch' END AS issue FROM j""",
)
def vl08(spark, sf):
    cells = part_cells(spark, sf)
    specs = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("record_id"),
        (F.col("o_custkey") * 2).alias("row"),
        F.lit(3).cast("bigint").alias("column"),
        F.lit("number").alias("expected_kind"),
    )
    lookups = L.lookup_cells(
        specs, cells.filter("sheet != 'PROMO'"), ["row", "column"], "expected_kind"
    )
    guards = L.check_guards(
        order_guards(spark, sf), cells.drop("sheet"), ["row", "column"]
    )
    return PRU.record_report(lookups, guards)


@query(
    "vl09_spec_rows",
    """
    WITH r AS (SELECT n_regionkey AS set_id, c_name AS value_id, c_custkey, c_mktsegment, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT set_id, value_id, 'malformed_row_column' AS code, 'row_column' AS field FROM r WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT set_id, value_id, 'missing_row_constraints', 'constraints' FROM r WHERE c_acctbal < 0 AND c_mktsegment <> 'HOUSEHOLD'
    UNION ALL SELECT set_id, value_id, 'missing_bound_constraint', 'agi_lower_usd' FROM r WHERE c_acctbal < 0 OR c_mktsegment = 'FURNITURE'
    UNION ALL SELECT set_id, NULL, 'duplicate_row_ordinal', 'row_ordinal' FROM (SELECT set_id, c_custkey // 2 AS o FROM r GROUP BY 1, 2 HAVING count(*) > 1)""",
)
def vl09_rows(spark, sf):
    _, rows, _ = spec_tables(spark, sf)
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("value_id"), "c_acctbal", "c_mktsegment"
    )
    segment = F.col("c_mktsegment")
    term = lambda op, value: F.struct(F.lit(op).alias("operator"), F.lit(value).alias("value"))
    none = F.array().cast("array<struct<operator:string,value:string>>")
    spoiled = rows.join(customers, "value_id").select(
        "set_id",
        "value_id",
        F.floor(F.col("row_ordinal") / 2).alias("row_ordinal"),
        F.when(segment == "MACHINERY", "Z1").when(segment == "BUILDING", "AB").alias("row_column"),
        F.create_map(
            F.lit("segment"), segment, F.lit("agi_lower_usd"), F.lit("1000"), F.lit("x"), F.lit("all")
        ).alias("filters"),
        F.when(F.col("c_acctbal") < 0, none)
        .when(segment == "FURNITURE", F.array(term(">=", "999")))
        .otherwise(F.array(term("<", "1"), term(">=", "1000")))
        .alias("terms"),
        F.when(segment == "HOUSEHOLD", "total").otherwise("detail").alias("table_record_kind"),
    )
    found = PRU.validate_spec_rows(spoiled, "filters", "terms")
    # Repeated ordinals are reported by their ordinal, not by a row id.
    ordinal = F.col("code") == "duplicate_row_ordinal"
    return found.withColumn("value_id", F.when(~ordinal, F.col("value_id")))


@query(
    "vl09_spec_measures",
    """
    SELECT p_brand AS set_id, p_name AS measure_id, 'malformed_measure_column' AS code, 'measure_column' AS field FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT p_brand, p_name, 'malformed_measure_aggregation', 'aggregation' FROM part WHERE p_type = 'SMALL'
    UNION ALL SELECT p_brand, p_name, 'missing_concept_evidence', 'concept_relation' FROM part WHERE p_size > 40 AND p_type <> 'LARGE'
    UNION ALL SELECT p_brand, p_name, 'missing_concept_relation', 'concept_relation' FROM part WHERE p_size <= 10
    UNION ALL SELECT p_brand, p_name, 'missing_source_concept', 'source_concept' FROM part WHERE p_size BETWEEN 11 AND 20
    UNION ALL SELECT p_brand, p_name, 'duplicate_measure_id', 'measure_id' FROM part GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT p_brand, CAST(p_size AS VARCHAR), 'duplicate_measure_ordinal', 'measure_ordinal' FROM part GROUP BY p_brand, p_size HAVING count(*) > 1""",
)
def vl09_measures(spark, sf):
    kind, size = F.col("p_type"), F.col("p_size")
    measures = table(spark, sf, "part").select(
        F.col("p_brand").alias("set_id"),
        F.col("p_name").alias("measure_id"),
        size.alias("measure_ordinal"),
        F.when(kind == "PROMO", "b").otherwise("AB").alias("measure_column"),
        F.when(kind == "SMALL", "total").otherwise("sum").alias("aggregation"),
        F.when(size > 10, "exact").alias("concept_relation"),
        F.when((size <= 10) | (size > 20), "c").alias("source_concept"),
        F.when(kind == "LARGE", "https://example.org").alias("evidence_url"),
        F.when(size.between(11, 40), "read").alias("evidence_notes"),
    )
    return PRU.validate_spec_measures(measures)


@query(
    "vl12_alignment_evidence",
    f"""
    WITH {SQL_FACTS}, a AS (SELECT source_concept, concept AS canonical_concept, concept_relation AS relation, legal_vintage, min(seq) AS seq, arg_min(coalesce(concept_evidence_url, ''), seq) AS u
      FROM facts WHERE source_concept IS NOT NULL GROUP BY ALL)
    SELECT source_concept, canonical_concept, legal_vintage, 'missing_concept_evidence' AS code FROM a WHERE relation = 'exact' AND u = ''""",
)
def vl12(spark, sf):
    from factloom.operators.coverage import distinct_alignments

    found = PRU.alignments_without_evidence(distinct_alignments(order_facts(spark, sf)))
    return found.select("source_concept", "canonical_concept", "legal_vintage", "code")


@query(
    "vl13_boundary_rule",
    f"""
    WITH {SQL_FACTS} SELECT seq, CASE WHEN seg = 'BUILDING' THEN 'cites_store' WHEN pr = '1' THEN 'cites_derived_file' WHEN seg = 'MACHINERY' THEN 'cites_derived_location'
      WHEN st = 'P' THEN 'cites_derived_record' END AS reason FROM facts""",
)
def vl13(spark, sf):
    c = F.col
    source = c("source")
    segment = c("source.source_name")
    facts = order_facts(spark, sf).select(
        "seq",
        source.withField(
            "source_name",
            F.when(segment == "bureau_building", "FactLoom").otherwise(segment),
        )
        .withField(
            "source_file",
            F.when(c("entity.name") == "household", "derived:x").otherwise(
                c("source.source_file")
            ),
        )
        .withField(
            "raw_uri",
            F.when(segment == "bureau_machinery", "store://derived/x").otherwise(
                c("source.raw_uri")
            ),
        )
        .alias("source"),
        F.concat(
            "source_record_id", F.when(c("period.type") == "month", ".derived").otherwise("")
        ).alias("source_record_id"),
    )
    reason = PRU.derived_source(["factloom"], ["store://derived/"])
    return facts.select("seq", reason.alias("reason"))


@query(
    "vl14_declared_mismatch",
    """
    WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), d AS (SELECT c_custkey, c_nationkey - 2 AS n FROM customer WHERE c_acctbal > 0)
    SELECT coalesce(c_custkey, o_custkey) AS custkey, CAST(d.n AS BIGINT) AS row_count, a.n AS actual_count,
      CASE WHEN a.n IS NULL THEN 'missing' WHEN d.n IS NULL THEN 'undeclared' WHEN d.n <> a.n THEN 'count_mismatch' ELSE 'digest_mismatch' END AS issue
    FROM d FULL JOIN a ON c_custkey = o_custkey WHERE a.n IS NULL OR d.n IS NULL OR d.n <> a.n OR c_custkey % 2 = 1""",
)
def vl14(spark, sf):
    odd = F.col("custkey") % 2
    actual = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("digest", F.lit("d0"))
    )
    declared = (
        table(spark, sf, "customer")
        .filter("c_acctbal > 0")
        .select(
            F.col("c_custkey").alias("custkey"),
            (F.col("c_nationkey") - 2).cast("bigint").alias("row_count"),
        )
        .withColumn("digest", F.concat(F.lit("d"), odd))
    )
    return PRU.declared_mismatch(declared, actual, "custkey")


@query(
    "vl15_file_inventory",
    """
    SELECT doc_id AS entry, CASE WHEN lang = 'de' THEN 'missing_filename' WHEN lang = 'es' THEN 'missing_file' WHEN lang = 'fr' THEN 'checksum_mismatch' END AS issue,
      CASE WHEN lang IN ('en', 'fr') THEN octet_length(encode(text)) END AS size_bytes, source = 'src1' AS linked FROM documents""",
)
def vl15(spark, sf):
    docs = table(spark, sf, "documents")
    lang, name = F.col("lang"), F.concat(F.lit("doc-"), "doc_id", F.lit(".txt"))
    files = docs.filter("lang != 'es'").select(
        name.alias("filename"),
        F.sha2("text", 256).alias("actual_sha256"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
    )
    manifest = docs.select(
        F.col("doc_id").alias("entry"),
        F.when(lang == "de", "").otherwise(name).alias("filename"),
        F.when(lang == "fr", "0").otherwise(F.sha2("text", 256)).alias("sha256"),
        (F.col("source") == "src1").alias("linked"),
    )
    return PRU.file_inventory(manifest, files)


@query(
    "vl16_expected_constraints",
    f"WITH {SQL_FACTS} SELECT seq FROM facts WHERE st = 'P' AND pr NOT IN ('1', '2', '4')",
)
def vl16(spark, sf):
    bare = F.when(
        F.col("period.type") == "month", F.create_map(F.lit("x"), F.lit("all"))
    ).otherwise(F.col("filters"))
    facts = order_facts(spark, sf).withColumn("filters", bare)
    return facts.filter(PRU.lacks_constraints()).select("seq")


@query(
    "vl17_profile_rules",
    """
    SELECT p_brand AS profile_id, p_name AS target_id, 'duplicate_target_id' AS code FROM part GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT p_brand, p_name, 'missing_geography_levels' FROM part WHERE p_size < 5""",
)
def vl17(spark, sf):
    levels = F.when(F.col("p_size") >= 5, F.array(F.lit("state"))).otherwise(
        F.array().cast("array<string>")
    )
    targets = table(spark, sf, "part").select(
        F.col("p_brand").alias("profile_id"),
        F.col("p_name").alias("target_id"),
        levels.alias("geography_levels"),
    )
    return PRU.validate_profiles(targets)
