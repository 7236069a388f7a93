"""The fact table that many queries share: one fact per order.

Value is the order price; the nation of the customer is the geography, the
order year (or month, for open orders) the period, the market segment the
source and the concept.  ``SQL_FACTS`` is the same table, flat, in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import keys as K
from factloom.functions.scalars import number_text, padded_code
from factloom.plans import facts as P
from factloom.suite.registry import sql_digest, sql_number_text, sql_record, table

SQL_FACTS = f"""
facts0 AS (SELECT o_orderkey AS seq, o_custkey, o_totalprice AS value_num,
    {sql_number_text('o_totalprice')} AS value_text,
    CAST(year(o_orderdate) AS BIGINT) AS y, o_orderstatus AS st, substr(o_orderpriority, 1, 1) AS pr,
    c_mktsegment AS seg, lower(c_mktsegment) AS lseg, n_nationkey, n_name, n_regionkey,
    strftime(o_orderdate, '%Y-%m') AS ym
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
facts AS (SELECT *,
    CASE st WHEN 'P' THEN 'month' ELSE 'calendar_year' END AS period_type,
    CASE st WHEN 'P' THEN ym ELSE CAST(y AS VARCHAR) END AS period_value,
    CASE n_regionkey WHEN 0 THEN 'country' ELSE 'state' END AS geography_level,
    '0400000US' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geography_id,
    CASE WHEN st <> 'F' THEN '2020' END AS geography_vintage, n_name AS geography_name,
    CASE pr WHEN '1' THEN 'household' WHEN '2' THEN 'person' WHEN '3' THEN 'tax_unit' WHEN '4' THEN 'family' ELSE 'return' END AS entity_name,
    'us.trade.' || lseg AS concept, 'usd' AS unit,
    CASE WHEN seg <> 'MACHINERY' THEN seg END AS source_concept,
    CASE seg WHEN 'BUILDING' THEN 'exact' WHEN 'AUTOMOBILE' THEN 'broad_match' WHEN 'FURNITURE' THEN 'narrow_match' WHEN 'HOUSEHOLD' THEN 'approximate' END AS concept_relation,
    CASE WHEN seg <> 'MACHINERY' THEN 'bureau' END AS concept_authority,
    CASE WHEN seg = 'BUILDING' AND st = 'F' THEN 'https://example.org/' || lseg END AS concept_evidence_url,
    CASE WHEN st = 'O' THEN '2023' END AS legal_vintage,
    CASE pr WHEN '5' THEN 'survey_aggregate' ELSE 'administrative' END AS provenance_class,
    CASE pr WHEN '5' THEN 'household panel' END AS survey_instrument,
    CASE WHEN y >= 2001 THEN 'source_projection' ELSE 'observation' END AS assertion,
    CASE st WHEN 'F' THEN 'single' WHEN 'O' THEN 'all' END AS filing_status,
    CASE WHEN value_num >= 300000 THEN '300000' WHEN value_num >= 100000 THEN '100000' END AS agi_lower_usd,
    CASE WHEN value_num < 100000 THEN '100000' WHEN value_num < 300000 THEN '300000' END AS agi_upper_usd,
    CASE pr WHEN '1' THEN '1' WHEN '2' THEN '2' WHEN '3' THEN '3plus' WHEN '4' THEN 'all' END AS eitc_child_count,
    CASE WHEN value_num < 100000 THEN 'under_100k' WHEN value_num < 300000 THEN '100k_to_300k' ELSE '300k_plus' END AS income_range,
    'R' || CAST(n_regionkey AS VARCHAR) AS trade_region,
    'bureau_' || lseg AS source_name, 'table_' || CAST(y AS VARCHAR) AS source_table,
    'table_' || CAST(y AS VARCHAR) || '.csv' AS source_file,
    CASE WHEN st <> 'P' THEN 'https://example.org/' || lseg || '/' || CAST(y AS VARCHAR) END AS url,
    CAST(y AS VARCHAR) AS vintage, sha256(lseg || '/' || CAST(y AS VARCHAR)) AS source_sha256,
    1000 + y AS source_size_bytes, 'raw' AS raw_bucket,
    'raw/' || lseg || '/' || CAST(y AS VARCHAR) AS raw_key, 'store://raw/' || lseg || '/' || CAST(y AS VARCHAR) AS raw_uri,
    'bureau_' || lseg || '.table_' || CAST(y AS VARCHAR) AS record_set_id, 'bureau_' || lseg || '.spec' AS record_set_spec_id,
    CASE pr WHEN '1' THEN 'geography' WHEN '4' THEN NULL ELSE 'us.trade.trade_region' END AS groupby_dimension,
    CASE WHEN st <> 'P' THEN 'total_price' END AS measure_id,
    CASE pr WHEN '2' THEN 'total' ELSE 'detail' END AS table_record_kind,
    'bureau_' || lseg || '.table_' || CAST(y AS VARCHAR) || '.' || CAST(seq AS VARCHAR) AS source_record_id,
    CASE WHEN st = 'O' THEN 1 ELSE 0 END AS n_explicit
  FROM facts0)
"""


def flat_facts(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders", heavy=True)
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    nations = table(spark, sf, "nation")
    base = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    year = F.year("o_orderdate").cast("bigint")
    year_text = year.cast("string")
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    digit = F.substring("o_orderpriority", 1, 1)
    segment, low = F.col("c_mktsegment"), F.lower("c_mktsegment")
    aligned = segment != "MACHINERY"
    name = F.concat(F.lit("bureau_"), low)
    table_name = F.concat(F.lit("table_"), year_text)
    place = F.concat(low, F.lit("/"), year_text)
    record_set = F.concat(name, F.lit("."), table_name)

    def by_digit(*values):
        result = None
        for number, value in enumerate(values, 1):
            test = digit == str(number)
            result = F.when(test, value) if result is None else result.when(test, value)
        return result

    filters = {
        "filing_status": F.when(status == "F", "single").when(status == "O", "all"),
        "agi_lower_usd": F.when(price >= 300000, "300000").when(
            price >= 100000, "100000"
        ),
        "agi_upper_usd": F.when(price < 100000, "100000").when(
            price < 300000, "300000"
        ),
        "eitc_child_count": by_digit("1", "2", "3plus", "all"),
        "income_range": F.when(price < 100000, "under_100k")
        .when(price < 300000, "100k_to_300k")
        .otherwise("300k_plus"),
        "trade_region": F.concat(F.lit("R"), F.col("n_regionkey").cast("string")),
    }
    no_constraints = F.array().cast(f"array<{P.CONSTRAINT}>")
    no_keys = F.array().cast("array<string>")
    sha = F.sha2(place, 256)
    row_key = K.row_key(sha, F.lit("orders"), F.col("o_orderkey"))
    cells = F.array(
        *[
            K.cell_key(sha, F.lit("orders"), F.col("o_orderkey"), F.lit(column))
            for column in (4, 1)
        ]
    )
    return base.select(
        F.col("o_orderkey").alias("seq"),
        "o_custkey",
        price.alias("value_num"),
        number_text(price).alias("value_text"),
        F.lit("number").alias("value_type"),
        F.when(status == "P", "month").otherwise("calendar_year").alias("period_type"),
        F.when(status == "P", F.date_format("o_orderdate", "yyyy-MM"))
        .otherwise(year_text)
        .alias("period_value"),
        F.when(status != "P", year).alias("period_int"),
        F.when(F.col("n_regionkey") == 0, "country")
        .otherwise("state")
        .alias("geography_level"),
        padded_code(F.col("n_nationkey"), 2, "0400000US").alias("geography_id"),
        F.when(status != "F", "2020").alias("geography_vintage"),
        F.col("n_name").alias("geography_name"),
        by_digit("household", "person", "tax_unit", "family", "return").alias(
            "entity_name"
        ),
        F.concat(F.lit("us.trade."), low).alias("concept"),
        F.lit("usd").alias("unit"),
        F.when(aligned, segment).alias("source_concept"),
        F.when(segment == "BUILDING", "exact")
        .when(segment == "AUTOMOBILE", "broad_match")
        .when(segment == "FURNITURE", "narrow_match")
        .when(segment == "HOUSEHOLD", "approximate")
        .alias("concept_relation"),
        F.when(aligned, "bureau").alias("concept_authority"),
        F.when(
            (segment == "BUILDING") & (status == "F"),
            F.concat(F.lit("https://example.org/"), low),
        ).alias("concept_evidence_url"),
        F.when(status == "O", "2023").alias("legal_vintage"),
        F.lit("sum").alias("aggregation_method"),
        F.lit("trade").alias("domain"),
        F.when(digit == "5", "survey_aggregate")
        .otherwise("administrative")
        .alias("provenance_class"),
        F.when(digit == "5", "household panel").alias("survey_instrument"),
        F.when(year >= 2001, "source_projection")
        .otherwise("observation")
        .alias("assertion"),
        F.map_filter(
            F.create_map(
                *[part for key, value in filters.items() for part in (F.lit(key), value)]
            ),
            lambda _, value: value.isNotNull(),
        ).alias("filters"),
        F.when(
            status == "O",
            F.array(P.constraint("us.age", ">=", "18", "year", "Adult")),
        )
        .otherwise(no_constraints)
        .alias("constraints"),
        name.alias("source_name"),
        table_name.alias("source_table"),
        F.concat(table_name, F.lit(".csv")).alias("source_file"),
        F.when(
            status != "P", F.concat(F.lit("https://example.org/"), place)
        ).alias("url"),
        year_text.alias("vintage"),
        F.lit("2026-01-01").alias("extracted_at"),
        F.lit("scan").alias("extraction_method"),
        sha.alias("source_sha256"),
        (1000 + year).alias("source_size_bytes"),
        F.lit("raw").alias("raw_bucket"),
        F.concat(F.lit("raw/"), place).alias("raw_key"),
        F.concat(F.lit("store://raw/"), place).alias("raw_uri"),
        record_set.alias("record_set_id"),
        F.concat(name, F.lit(".spec")).alias("record_set_spec_id"),
        by_digit(
            "geography",
            "us.trade.trade_region",
            "us.trade.trade_region",
            None,
            "us.trade.trade_region",
        ).alias("groupby_dimension"),
        F.when(status != "P", "total_price").alias("measure_id"),
        F.when(digit == "2", "total").otherwise("detail").alias("table_record_kind"),
        F.concat(record_set, F.lit("."), F.col("o_orderkey").cast("string")).alias(
            "source_record_id"
        ),
        F.when(status != "P", F.array(row_key)).otherwise(no_keys).alias(
            "source_row_keys"
        ),
        cells.alias("source_cell_keys"),
        F.when(status == "F", F.concat(year_text, F.lit("-01-01"))).alias(
            "coverage_start"
        ),
        F.when(status == "F", F.lit("calendar")).alias("coverage_basis"),
    )


def order_facts(spark, sf) -> DataFrame:
    """Nested facts, labelled unless the order is open."""
    facts = P.nest_facts(flat_facts(spark, sf))
    return facts.withColumn(
        "label", F.when(F.col("period.type") != "month", P.fact_label())
    )


# --- SQL texts of the keys over SQL_FACTS --------------------------------------
SQL_AGE = sql_record(
    {
        "variable": "'us.age'",
        "operator": "'>='",
        "value": "'18'",
        "unit": "'year'",
        "role": "NULL",
    }
)
SQL_FILTER_MAP = """concat_ws('|',
  'agi_lower_usd=' || agi_lower_usd, 'agi_upper_usd=' || agi_upper_usd, 'eitc_child_count=' || eitc_child_count,
  'filing_status=' || filing_status, 'income_range=' || income_range, 'trade_region=' || trade_region)"""
SQL_PLACE = {
    "geography_level": "geography_level",
    "geography_id": "geography_id",
    "geography_vintage": "geography_vintage",
}
SQL_PERIOD = {"period_type": "period_type", "period_value": "period_value"}
SQL_ASSERTION = "nullif(assertion, 'observation')"


def sql_items(text: str) -> str:
    """One-item sequence: the item text escaped once more."""
    return rf"replace(replace({text}, '\', '\\'), '|', '\|')"


SQL_RELEASE = sql_digest(
    "source_release.v2",
    sql_record(
        {
            n: n
            for n in (
                "source_name",
                "source_table",
                "source_file",
                "url",
                "vintage",
                "source_sha256",
                "source_size_bytes",
                "raw_uri",
            )
        }
    ),
)
SQL_SERIES = sql_digest(
    "source_series.v2",
    sql_record({n: n for n in ("source_name", "source_table", "record_set_spec_id")}),
)
SQL_OBSERVED = sql_digest(
    "observed_measure.v2",
    sql_record(
        {
            "source_name": "source_name",
            "source_table": "source_table",
            "source_measure_id": "coalesce(measure_id, source_concept, concept)",
            "source_concept": "coalesce(source_concept, concept)",
            "unit": "unit",
        }
    ),
)
SQL_DIMENSIONS = sql_digest("dimension_set.v2", SQL_FILTER_MAP)
SQL_UNIVERSE = sql_digest(
    "universe_constraint_set.v2",
    sql_record(
        {
            "domain": "'trade'",
            "constraints": f"CASE WHEN n_explicit > 0 THEN {sql_items(SQL_AGE)} END",
        }
    ),
)
SQL_FACT_V1 = sql_digest(
    "fact.v1",
    "concat_ws('|', "
    + sql_record(
        {
            **SQL_PERIOD,
            **SQL_PLACE,
            "entity": "entity_name",
            "entity_role": "NULL",
            "concept": "concept",
            "unit": "unit",
            "source_concept": "source_concept",
            "concept_relation": "concept_relation",
            "concept_authority": "concept_authority",
            "concept_evidence_url": "concept_evidence_url",
            "concept_evidence_notes": "NULL",
            "legal_vintage": "legal_vintage",
            "method": "'sum'",
            "denominator": "NULL",
            "domain": "'trade'",
            "filters": SQL_FILTER_MAP,
            "source_name": "source_name",
            "source_table": "source_table",
            "source_file": "source_file",
            "vintage": "vintage",
        },
        keep_nulls=True,
    )
    + ", "
    + "nullif("
    + sql_record(
        {
            "constraints": "CASE WHEN n_explicit > 0 THEN "
            + sql_items(
                sql_record(
                    {
                        "variable": "'us.age'",
                        "operator": "'>='",
                        "value": "'18'",
                        "unit": "'year'",
                        "role": "NULL",
                        "label": "'Adult'",
                    },
                    keep_nulls=True,
                )
            )
            + " END",
            "assertion": SQL_ASSERTION,
        }
    )
    + ", ''))",
)
SQL_AGGREGATE = sql_digest(
    "aggregate_fact.v2",
    sql_record(
        {
            "source_release_key": "source_release_key",
            "source_series_key": "source_series_key",
            "observed_measure_key": "observed_measure_key",
            "method": "'sum'",
            "denominator": "NULL",
            **SQL_PERIOD,
            **SQL_PLACE,
            "entity": "entity_name",
            "entity_role": "NULL",
            "dimension_set_key": "dimension_set_key",
            "universe_constraint_set_key": "universe_constraint_set_key",
            "assertion": SQL_ASSERTION,
        }
    ),
)
SQL_SEMANTIC = sql_digest(
    "semantic_fact.v2",
    sql_record(
        {
            "concept": "concept",
            "unit": "unit",
            "method": "'sum'",
            "denominator": "NULL",
            **SQL_PERIOD,
            **SQL_PLACE,
            "entity": "entity_name",
            "entity_role": "NULL",
            "universe_constraint_set_key": "universe_constraint_set_key",
            "assertion": SQL_ASSERTION,
        }
    ),
)
SQL_ALIGNMENT = (
    "CASE WHEN source_concept IS NOT NULL OR legal_vintage IS NOT NULL THEN "
    + sql_digest(
        "concept_alignment.v2",
        sql_record(
            {
                "observed_measure_key": "observed_measure_key",
                "canonical_concept": "concept",
                "relation": "concept_relation",
                "authority": "concept_authority",
                "legal_vintage": "legal_vintage",
            }
        ),
    )
    + " END"
)
SQL_KEYED = f"""
keyed0 AS (SELECT *, {SQL_RELEASE} AS source_release_key, {SQL_SERIES} AS source_series_key,
    {SQL_OBSERVED} AS observed_measure_key, {SQL_DIMENSIONS} AS dimension_set_key,
    {SQL_UNIVERSE} AS universe_constraint_set_key, {SQL_FACT_V1} AS legacy_fact_key FROM facts),
keyed AS (SELECT *, {SQL_AGGREGATE} AS aggregate_fact_key, {SQL_SEMANTIC} AS semantic_fact_key,
    {SQL_ALIGNMENT} AS concept_alignment_key FROM keyed0)
"""
