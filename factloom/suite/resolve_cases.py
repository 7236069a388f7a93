"""Queries for target matching, the period rule and profile resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.plans import resolve as PR
from factloom.suite.fact_base import SQL_FACTS, order_facts
from factloom.suite.registry import query, table

REQUESTED = "1997"

def customer_facts(spark, sf):
    """Order count per customer and period; open orders are monthly facts."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.expr("o_custkey = c_custkey")
    )
    opened = F.col("o_orderstatus") == "P"
    year = F.year("o_orderdate").cast("bigint")
    low = F.lower("c_mktsegment")
    return (
        orders.groupBy(
            F.col("c_name").alias("record_set_id"),
            F.concat(F.lit("bureau_"), low).alias("source_name"),
            F.concat(F.lit("us.trade."), low).alias("concept"),
            F.when(opened, "month").otherwise("calendar_year").alias("period_type"),
            F.when(opened, F.date_format("o_orderdate", "yyyy-MM"))
            .otherwise(year.cast("string"))
            .alias("period_value"),
            F.when(~opened, year).alias("period_int"),
            F.when(opened | (year < 2001), "observation")
            .otherwise("source_projection")
            .alias("assertion"),
        )
        .agg(F.count("*").alias("value"))
        .withColumn("geography_level", F.lit("state"))
    )


SQL_CUSTOMER_FACTS = """
cf AS (SELECT c_custkey, c_name, c_mktsegment AS seg, CASE o_orderstatus WHEN 'P' THEN 'month' ELSE 'calendar_year' END AS pt,
    CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y-%m') ELSE CAST(year(o_orderdate) AS VARCHAR) END AS pv,
    CASE WHEN o_orderstatus = 'P' OR year(o_orderdate) < 2001 THEN 'observation' ELSE 'source_projection' END AS assertion, count(*) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
tg AS (SELECT c_custkey, c_mktsegment AS seg, 't' || c_custkey AS target_id, c_acctbal FROM customer WHERE c_acctbal >= 0 OR c_mktsegment = 'BUILDING'),
mt AS (SELECT target_id, pt, pv, cf.assertion, value FROM tg JOIN cf USING (c_custkey) WHERE tg.seg <> 'HOUSEHOLD' AND (tg.seg <> 'MACHINERY' OR cf.assertion = 'observation'))"""


def customer_targets(spark, sf):
    segment, low = F.col("c_mktsegment"), F.lower("c_mktsegment")
    key = (F.lit("record_set_id"), F.col("c_name"))

    def selector(*extra):
        return F.create_map(*key, *extra)

    chosen = (
        F.when(segment == "BUILDING", selector())
        .when(
            segment == "AUTOMOBILE",
            selector(F.lit("source_name"), F.concat(F.lit("bureau_"), low)),
        )
        .when(
            segment == "FURNITURE",
            selector(F.lit("concept"), F.concat(F.lit("us.trade."), low)),
        )
        .when(segment == "HOUSEHOLD", selector(F.lit("colour"), F.lit("red")))
        .otherwise(selector(F.lit("assertion"), F.lit("observation")))
    )
    levels = F.when(
        (F.col("c_acctbal") >= 0) | (segment == "BUILDING"),
        F.array(F.lit("country"), F.lit("state")),
    ).otherwise(F.array(F.lit("country")))
    return table(spark, sf, "customer").select(
        F.concat(F.lit("t"), "c_custkey").alias("target_id"),
        chosen.alias("selector"),
        levels.alias("geography_levels"),
        "c_acctbal",
    )


def own_alignments(spark, sf):
    rich = customer_targets(spark, sf).filter("c_acctbal > 5000")
    return rich.select("target_id", F.lit("aged forward").alias("alignment"))


@query(
    "jn08_match_targets",
    f"WITH {SQL_CUSTOMER_FACTS} SELECT target_id, pt AS period_type, pv AS period_value, assertion, count(*) AS fact_count FROM mt GROUP BY ALL",
)
def jn08(spark, sf):
    match = PR.matcher(customer_targets(spark, sf), customer_facts(spark, sf), "state")
    return match.combinations().drop("period_int")


SQL_CHOICE = f"""{SQL_CUSTOMER_FACTS},
ch0 AS (SELECT target_id, count(*) AS matched, bool_or(pt = 'calendar_year' AND pv = '{REQUESTED}') AS exact,
    max(CASE WHEN pt = 'calendar_year' AND CAST(left(pv, 4) AS INT) <= {REQUESTED} THEN pv END) AS upto, max(pv) AS latest,
    min(pt) AS t0, max(pt) AS t1 FROM mt GROUP BY 1),
ch AS (SELECT target_id, matched, exact, CASE WHEN exact OR upto IS NOT NULL THEN 'calendar_year' WHEN t0 = t1 THEN t0 END AS period_type,
    CASE WHEN exact THEN '{REQUESTED}' WHEN upto IS NOT NULL THEN upto WHEN t0 = t1 THEN latest END AS period_value FROM ch0)"""


@query(
    "wn01_period_choice",
    f"WITH {SQL_CHOICE} SELECT target_id, CAST(matched AS BIGINT) AS matched, period_type, period_value, exact FROM ch",
)
def wn01(spark, sf):
    match = PR.matcher(customer_targets(spark, sf), customer_facts(spark, sf), "state")
    return PR.choose_period(match.combinations(), "calendar_year", REQUESTED)


SQL_OUTCOME = f"""{SQL_CHOICE},
oc AS (SELECT target_id, c_acctbal > 5000 AS own, exact, period_type, period_value, CASE WHEN seg = 'HOUSEHOLD' THEN 'unknown_selector_key' WHEN matched IS NULL THEN 'no_matching_facts'
    WHEN period_value IS NULL THEN 'ambiguous_period_type' WHEN exact OR c_acctbal > 5000 OR {{wild}} THEN 'resolved' ELSE 'violation' END AS outcome
  FROM tg LEFT JOIN ch USING (target_id))"""


@query(
    "pt01_resolve_profile",
    f"""
    WITH {SQL_OUTCOME.format(wild='false')}
    SELECT oc.target_id, outcome, CASE WHEN outcome = 'resolved' THEN CASE WHEN exact THEN 'fact' ELSE 'declared_alignment' END END AS basis,
      period_type, period_value, value FROM oc LEFT JOIN mt ON oc.outcome = 'resolved' AND mt.target_id = oc.target_id AND mt.pt = period_type AND mt.pv = period_value""",
)
def pt01(spark, sf):
    targets = customer_targets(spark, sf)
    facts = customer_facts(spark, sf)
    match = PR.matcher(targets, facts, "state")
    state = PR.outcomes(
        targets, match, "calendar_year", REQUESTED, own_alignments(spark, sf), "state"
    )
    done = F.col("outcome") == "resolved"
    resolved = match.facts_at(
        state.filter(done).select(
            "target_id", "outcome", "basis", "period_type", "period_value"
        )
    ).select("target_id", "outcome", "basis", "period_type", "period_value", "value")
    open_targets = state.filter(~done).select(
        "target_id",
        "outcome",
        "basis",
        "period_type",
        "period_value",
        F.lit(None).cast("bigint").alias("value"),
    )
    return resolved.unionByName(open_targets)


@query(
    "pt01_violations",
    f"WITH {SQL_OUTCOME.format(wild='false')} SELECT target_id, period_type, period_value FROM oc WHERE outcome = 'violation'",
)
def pt01_violations(spark, sf):
    return PR.resolve(
        customer_targets(spark, sf),
        customer_facts(spark, sf),
        "calendar_year",
        REQUESTED,
        own_alignments(spark, sf),
        "state",
    ).violations


@query(
    "pt02_alignment_lookup",
    f"""
    WITH {SQL_OUTCOME.format(wild='true')}
    SELECT target_id, outcome, CASE WHEN outcome = 'resolved' AND NOT exact THEN CASE WHEN own THEN 'aged forward' ELSE 'carried' END END AS alignment,
      CASE WHEN outcome = 'resolved' AND exact AND own THEN 'unused_alignment' END AS warning FROM oc""",
)
def pt02(spark, sf):
    own = own_alignments(spark, sf)
    wild = spark.range(1).select(
        F.lit("*").alias("target_id"), F.lit("carried").alias("alignment")
    )
    targets = customer_targets(spark, sf)
    match = PR.matcher(targets, customer_facts(spark, sf), "state")
    return PR.outcomes(
        targets, match, "calendar_year", REQUESTED, own.unionByName(wild), "state"
    ).select("target_id", "outcome", "alignment", "warning")


@query(
    "ag06_target_coverage",
    f"""
    WITH {SQL_CUSTOMER_FACTS}, c AS (SELECT target_id, count(*) AS matched, string_agg(DISTINCT pt || ':' || pv, ',' ORDER BY pt || ':' || pv) AS periods,
      string_agg(DISTINCT assertion, ',' ORDER BY assertion) AS assertions FROM mt GROUP BY 1)
    SELECT target_id, 'state' AS geography_level, coalesce(matched, 0) AS matched, periods, assertions FROM tg LEFT JOIN c USING (target_id)
    UNION ALL SELECT 't' || c_custkey, 'country', 0, NULL, NULL FROM customer""",
)
def ag06(spark, sf):
    return PR.target_coverage(
        customer_targets(spark, sf),
        customer_facts(spark, sf),
        ["state", "country"],
    )


@query(
    "jn08_nested_fact_selectors",
    f"""
    WITH {SQL_FACTS}, k AS (SELECT *, concat_ws('|', CASE WHEN agi_lower_usd IS NOT NULL THEN 'agi_lower_usd' END, CASE WHEN agi_upper_usd IS NOT NULL THEN 'agi_upper_usd' END,
      CASE WHEN eitc_child_count IS NOT NULL THEN 'eitc_child_count' END, CASE WHEN filing_status IS NOT NULL THEN 'filing_status' END, 'income_range', 'trade_region') AS dims FROM facts)
    SELECT 'by-set-' || record_set_id AS target_id, count(*) AS facts FROM k WHERE geography_level = 'state' GROUP BY 1
    UNION ALL SELECT 'by-dims-' || dims || '-' || entity_name, count(*) FROM k WHERE geography_level = 'state' GROUP BY 1""",
)
def jn08_nested(spark, sf):
    facts = PR.selectable(order_facts(spark, sf), ["seq"])
    sets = facts.select("record_set_id").distinct()
    dims = facts.select("dimensions", "entity").distinct()
    level = F.array(F.lit("state")).alias("geography_levels")
    targets = sets.select(
        F.concat(F.lit("by-set-"), "record_set_id").alias("target_id"),
        F.create_map(F.lit("record_set_id"), F.col("record_set_id")).alias("selector"),
        level,
    ).unionByName(
        dims.select(
            F.concat_ws("-", F.lit("by-dims"), "dimensions", "entity").alias("target_id"),
            F.create_map(
                F.lit("dimensions"), F.col("dimensions"), F.lit("entity"), F.col("entity")
            ).alias("selector"),
            level,
        )
    )
    match = PR.matcher(targets, facts, "state")
    return match.combinations().groupBy("target_id").agg(
        F.sum("fact_count").alias("facts")
    )
