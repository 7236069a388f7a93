"""Queries for counts, duplicates, set operations and store reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import bands as B
from factloom.functions import keys as K
from factloom.operators import coverage as V
from factloom.operators import reshape as R
from factloom.operators import sequence as Q
from factloom.plans import bundle as BU
from factloom.plans import facts as P
from factloom.session import materialise
from factloom.sources import store as T
from factloom.suite.fact_base import SQL_FACTS, SQL_KEYED, order_facts
from factloom.suite.fact_cases import SQL_LIFTED
from factloom.suite.registry import query, table
from factloom.suite.selector_cases import part_cells


def union_counts(dims):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dim, {key} AS key, count(*) AS n FROM src WHERE {key} IS NOT NULL GROUP BY 2"
        for name, key in dims.items()
    )


_AG01 = {
    "by_source": "source_name",
    "by_geography": "geography_level || ':' || geography_id",
    "by_entity": "entity_name",
    "by_period": "period_type || ':' || period_value",
    "by_assertion": "assertion",
    "by_provenance_class": "provenance_class",
}


@query(
    "ag01_fact_counts",
    f"""
    WITH {SQL_FACTS}, src AS (SELECT * FROM facts) {union_counts(_AG01)}
    UNION ALL SELECT 'missing_labels', 'count', count(*) FROM src WHERE st = 'P'
    UNION ALL SELECT 'missing_lineage', 'count', 0
    UNION ALL SELECT 'missing_rows', 'count', count(*) FROM src WHERE st = 'P'""",
)
def ag01(spark, sf):
    facts = materialise(order_facts(spark, sf), "counted-facts")
    counts = V.counts_by(
        facts,
        {
            "by_source": F.coalesce("source.source_name", F.lit("missing")),
            "by_geography": F.concat_ws(":", "geography.level", "geography.id"),
            "by_entity": F.col("entity.name"),
            "by_period": F.concat_ws(":", "period.type", "period.value"),
            "by_assertion": F.col("assertion"),
            "by_provenance_class": F.col("provenance_class"),
        },
    )
    no_rows = F.size("source_row_keys") == 0
    missing = V.missing_counts(
        facts,
        {
            "missing_labels": F.col("label").isNull(),
            "missing_lineage": no_rows & (F.size("source_cell_keys") == 0),
            "missing_rows": no_rows,
        },
    )
    long = missing.unpivot([], missing.columns, "dim", "n").withColumn(
        "key", F.lit("count")
    )
    return counts.unionByName(long)


_AG02 = {
    "source": "source_name",
    "source_table": "source_name || ':' || source_table",
    "period": "period_type || ':' || period_value",
    "geography": "geography_level || ':' || geography_id",
    "entity": "entity_name",
    "measure": "source_name || ':' || coalesce(measure_id, source_concept, concept)",
    "observed_concept": "coalesce(source_concept, concept)",
    "canonical_concept": "CASE WHEN source_concept IS NOT NULL OR legal_vintage IS NOT NULL THEN concept END",
}


@query(
    "ag02_coverage_counts",
    f"WITH {SQL_FACTS}, src AS (SELECT * FROM facts) {union_counts(_AG02)}",
)
def ag02(spark, sf):
    rows = P.consumer_rows(order_facts(spark, sf))

    def pair(left, right):
        joined = F.concat_ws(":", F.nullif(left, F.lit("")), F.nullif(right, F.lit("")))
        return F.nullif(joined, F.lit(""))

    both = lambda left, right: F.concat(left, F.lit(":"), right)
    return V.counts_by(
        rows,
        {
            "source": F.col("source.source_name"),
            "source_table": pair(F.col("source.source_name"), F.col("source.source_table")),
            "period": both(F.col("period.type"), F.col("period.value")),
            "geography": both(F.col("geography.level"), F.col("geography.id")),
            "entity": F.col("entity.name"),
            "measure": pair(
                F.col("observed_measure.source_name"),
                F.col("observed_measure.source_measure_id"),
            ),
            "observed_concept": F.col("observed_measure.source_concept"),
            "canonical_concept": F.col("concept_alignment.canonical_concept"),
        },
    )


KEY_COLUMNS = [
    "aggregate_fact_key",
    "semantic_fact_key",
    "legacy_fact_key",
    "source_release_key",
    "source_series_key",
    "observed_measure_key",
    "universe_constraint_set_key",
]


@query(
    "ag03_distinct_keys",
    f"WITH {SQL_FACTS}, {SQL_KEYED} "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS dim, count(DISTINCT {k}) AS n FROM keyed" for k in KEY_COLUMNS
    ),
)
def ag03(spark, sf):
    rows = P.consumer_rows(order_facts(spark, sf))
    return V.distinct_counts(rows, KEY_COLUMNS)


@query(
    "ag04_duplicate_keys",
    f"WITH {SQL_FACTS}, {SQL_KEYED} SELECT semantic_fact_key, count(*) AS n FROM keyed GROUP BY 1 HAVING count(*) > 1",
)
def ag04(spark, sf):
    return V.duplicate_keys(P.consumer_rows(order_facts(spark, sf)), "semantic_fact_key")


@query(
    "ag04_duplicate_members",
    f"""
    WITH {SQL_FACTS}, {SQL_KEYED}, d AS (SELECT semantic_fact_key AS k FROM keyed GROUP BY 1 HAVING count(*) > 1)
    SELECT DISTINCT semantic_fact_key, 'source' AS kind, source_name || ':' || source_table AS member FROM keyed JOIN d ON k = semantic_fact_key
    UNION ALL SELECT DISTINCT semantic_fact_key, 'legacy_fact_key', legacy_fact_key FROM keyed JOIN d ON k = semantic_fact_key""",
)
def ag04_members(spark, sf):
    rows = P.consumer_rows(order_facts(spark, sf))
    return V.duplicate_members(
        materialise(rows, "consumer-rows"),
        "semantic_fact_key",
        {
            "source": F.concat_ws(":", "source.source_name", "source.source_table"),
            "legacy_fact_key": F.col("legacy_fact_key"),
        },
    )


@query(
    "ag05_duplicate_positions",
    """
    WITH d AS (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS first_position FROM orders GROUP BY 1 HAVING count(*) > 1)
    SELECT o_custkey, o_orderkey, n, first_position FROM orders JOIN d USING (o_custkey)""",
)
def ag05(spark, sf):
    return V.duplicate_positions(table(spark, sf, "orders"), "o_custkey", "o_orderkey")


@query(
    "ag07_cell_counts",
    """
    SELECT p_type AS sheet, 'text' AS kind, 2 * count(*) AS cells, 2 * count(*) AS nonempty FROM part GROUP BY 1
    UNION ALL SELECT p_type, 'number', 2 * count(*), 2 * count(*) FROM part GROUP BY 1""",
)
def ag07(spark, sf):
    return V.cell_counts(part_cells(spark, sf), ["sheet", "kind"])


@query(
    "ag08_row_counts",
    "SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY 1, 2",
)
def ag08(spark, sf):
    return V.row_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    "ag10_lineage_coverage",
    """
    WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
    SELECT count(*) AS records, count(*) FILTER (o_orderstatus <> 'P') AS resolved, count(*) FILTER (o_orderstatus <> 'P' AND n > 0) AS lineaged,
      (count(*) FILTER (o_orderstatus <> 'P' AND n > 0))::DOUBLE / count(*) FILTER (o_orderstatus <> 'P') AS lineage_ratio FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""",
)
def ag10(spark, sf):
    lines = (
        table(spark, sf, "lineitem")
        .filter("l_returnflag = 'A'")
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("lineage_count"))
    )
    records = table(spark, sf, "orders").join(
        lines, F.expr("o_orderkey = l_orderkey"), "left"
    )
    return V.lineage_coverage(
        records.select(
            (F.col("o_orderstatus") != "P").alias("resolved"),
            F.coalesce("lineage_count", F.lit(0)).alias("lineage_count"),
        )
    )


def stored_targets(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("source"),
        F.year("o_orderdate").cast("bigint").alias("period"),
        F.col("o_orderstatus").alias("variable"),
        F.col("o_custkey").alias("stratum_id"),
    )


@query(
    "ag11_store_stats",
    """
    SELECT count(*) AS targets, count(DISTINCT o_orderpriority) AS sources, count(DISTINCT year(o_orderdate)) AS periods,
      CAST(min(year(o_orderdate)) AS BIGINT) AS first_period, CAST(max(year(o_orderdate)) AS BIGINT) AS last_period, (SELECT count(*) FROM customer) AS strata FROM orders""",
)
def ag11(spark, sf):
    return V.store_stats(
        stored_targets(spark, sf), table(spark, sf, "customer"), "source", "period"
    )


@query(
    "ag12_source_summary",
    """
    SELECT o_orderpriority AS source, count(*) AS count, count(DISTINCT o_orderstatus) AS variables, CAST(min(year(o_orderdate)) AS BIGINT) AS year_min,
      CAST(max(year(o_orderdate)) AS BIGINT) AS year_max, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years,
      min(year(o_orderdate)) >= 2024 AS is_projection FROM orders GROUP BY 1""",
)
def ag12(spark, sf):
    summary = V.source_summary(stored_targets(spark, sf))
    return summary.withColumn("years", F.array_join("years", ","))


@query(
    "ag12_group_sources",
    """
    WITH t AS (SELECT year(o_orderdate) AS y, o_orderpriority AS s, c_mktsegment AS j FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0)
    SELECT 'year' AS dim, CAST(y AS VARCHAR) AS key, count(*) AS count, string_agg(DISTINCT s, ',' ORDER BY s) AS sources FROM t GROUP BY 2
    UNION ALL SELECT 'jurisdiction', coalesce(j, 'unknown'), count(*), string_agg(DISTINCT s, ',' ORDER BY s) FROM t GROUP BY 2""",
)
def ag12_groups(spark, sf):
    areas = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("stratum_id"), "c_mktsegment"
    )
    targets = stored_targets(spark, sf)
    placed = targets.join(areas, "stratum_id", "left")
    by_year = V.group_sources(targets, F.col("period").cast("string"), "key")
    by_area = V.group_sources(
        placed, F.coalesce("c_mktsegment", F.lit("unknown")), "key"
    )
    both = by_year.withColumn("dim", F.lit("year")).unionByName(
        by_area.withColumn("dim", F.lit("jurisdiction"))
    )
    return both.withColumn("sources", F.array_join("sources", ","))


@query(
    "src12_dashboard_summary",
    """
    WITH s AS (SELECT o_orderpriority AS source, count(*) AS n, min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders GROUP BY 1),
    y AS (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1)
    SELECT '[' || (SELECT string_agg('{"source":"' || source || '","count":' || n || ',"year_min":' || lo || ',"year_max":' || hi || '}', ',' ORDER BY source) FROM s) || ']' AS sources,
      '[' || (SELECT string_agg('{"year":' || year || ',"count":' || n || '}', ',' ORDER BY year) FROM y) || ']' AS years""",
)
def src12(spark, sf):
    targets = stored_targets(spark, sf)
    by_year = V.group_sources(targets, F.col("period"), "year")
    return T.nested_summary(
        {
            "sources": (
                V.source_summary(targets),
                F.struct("source", "count", "year_min", "year_max"),
            ),
            "years": (by_year, F.struct("year", "count")),
        }
    )


def build_parts(spark, sf):
    facts = materialise(order_facts(spark, sf), "build-facts")
    columns = ["p_name", "p_brand", "p_size"]
    parts = table(spark, sf, "part").withColumn(
        "row_key",
        K.row_key(F.sha2("p_type", 256), F.col("p_type"), F.col("p_partkey")),
    )
    rows = parts.select("row_key", "p_type", "p_partkey")
    values = R.melt(parts, ["row_key", "p_type", "p_partkey"], columns)
    column_key = K.column_key(
        F.sha2("p_type", 256), F.col("p_type"), F.col("position"), F.col("raw_name")
    )
    values = values.withColumn("column_key", column_key).withColumn(
        "value_key", K.row_value_key(F.col("row_key"), F.col("column_key"))
    )
    cells = values.select(
        K.cell_key(
            F.sha2("p_type", 256), F.col("p_type"), F.col("p_partkey"), F.col("position")
        ).alias("cell_key"),
        "row_key",
        "kind",
        "value_text",
        "value_num",
    )
    return facts, rows, values, cells


@query(
    "ag14_build_counts",
    f"""
    WITH {SQL_FACTS}, {SQL_LIFTED}
    SELECT 'builds' AS table_name, 1::BIGINT AS n UNION ALL SELECT 'source_artifacts', count(DISTINCT source_sha256) FROM facts
    UNION ALL SELECT 'source_columns', 3 * count(DISTINCT p_type) FROM part UNION ALL SELECT 'source_rows', count(*) FROM part
    UNION ALL SELECT 'source_row_values', 3 * count(*) FROM part UNION ALL SELECT 'source_cells', 3 * count(*) FROM part
    UNION ALL SELECT 'source_records', count(DISTINCT source_record_id) FROM facts
    UNION ALL SELECT 'concept_alignments', count(*) FROM (SELECT DISTINCT source_concept, concept, concept_relation, legal_vintage, period_type, period_value FROM facts WHERE source_concept IS NOT NULL)
    UNION ALL SELECT 'aggregate_facts', count(*) FROM facts UNION ALL SELECT 'aggregate_constraints', count(*) FROM lifted
    UNION ALL SELECT 'fact_source_cells', 2 * count(*) FROM facts UNION ALL SELECT 'fact_source_rows', count(*) FROM facts WHERE st <> 'P'""",
)
def ag14(spark, sf):
    return V.table_sizes(T.snapshot(*build_parts(spark, sf)))


@query(
    "src09_snapshot_alignments",
    f"""
    WITH {SQL_FACTS} SELECT source_concept, concept AS canonical_concept, concept_relation AS relation, legal_vintage, period_type, period_value,
      min(seq) AS seq, arg_min(source_record_id, seq) AS source_record_id FROM facts WHERE source_concept IS NOT NULL GROUP BY ALL""",
)
def src09(spark, sf):
    tables = T.snapshot(*build_parts(spark, sf))
    return tables["concept_alignments"].drop("authority", "evidence_url", "evidence_notes")


@query(
    "src10_manifest",
    """
    SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
)
def src10_manifest(spark, sf):
    names = ("orders", "customer", "lineitem")
    return T.manifest({name: table(spark, sf, name) for name in names}).drop("digest")


@query(
    "ag15_multiset_shortfall",
    """
    WITH e AS (SELECT l_orderkey, l_returnflag, count(*) AS expected FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
    p AS (SELECT l_orderkey, l_returnflag, count(*) AS present FROM lineitem WHERE l_linestatus <> 'F' GROUP BY 1, 2)
    SELECT l_orderkey, l_returnflag, expected, coalesce(present, 0) AS present FROM e LEFT JOIN p USING (l_orderkey, l_returnflag) WHERE coalesce(present, 0) < expected""",
)
def ag15(spark, sf):
    lines = table(spark, sf, "lineitem")
    return V.multiset_shortfall(
        lines.filter("l_linestatus = 'F'"),
        lines.filter("l_linestatus != 'F'"),
        ["l_orderkey", "l_returnflag"],
    )


@query(
    "ag16_distinct_alignments",
    f"""
    WITH {SQL_FACTS} SELECT source_concept, concept AS canonical_concept, concept_relation AS relation, legal_vintage, min(seq) AS seq,
      arg_min(source_record_id, seq) AS source_record_id FROM facts WHERE source_concept IS NOT NULL GROUP BY ALL""",
)
def ag16(spark, sf):
    return V.distinct_alignments(order_facts(spark, sf)).drop(
        "evidence_url", "evidence_notes"
    )


@query(
    "ag17_source_records",
    f"WITH {SQL_FACTS} SELECT source_record_id, seq, CAST(CASE WHEN st <> 'P' THEN 1 ELSE 0 END AS INTEGER) AS row_count, 2 AS cell_count FROM facts",
)
def ag17(spark, sf):
    return T.source_records(order_facts(spark, sf))


@query(
    "ag18_source_artifacts",
    f"WITH {SQL_FACTS} SELECT source_sha256, min(seq) AS seq, arg_min(source_name, seq) AS source_name, arg_min(raw_uri, seq) AS raw_uri, arg_min(coalesce(url, '-'), seq) AS url FROM facts GROUP BY 1",
)
def ag18(spark, sf):
    return T.source_artifacts(order_facts(spark, sf)).select(
        "source_sha256",
        "seq",
        "source_name",
        "raw_uri",
        F.coalesce("url", F.lit("-")).alias("url"),
    )


@query(
    "wn04_adjacent_bands",
    """
    WITH b AS (SELECT DISTINCT o_custkey, CAST(floor(o_totalprice / 100000) AS BIGINT) AS lo FROM orders),
    c AS (SELECT o_custkey, lo, CASE WHEN lo = 4 THEN NULL ELSE lo + 1 END AS hi FROM b),
    w AS (SELECT *, lag(hi) OVER (PARTITION BY o_custkey ORDER BY lo) AS prev, row_number() OVER (PARTITION BY o_custkey ORDER BY lo) AS n FROM c),
    g AS (SELECT o_custkey, bool_and(n = 1 OR coalesce(prev = lo, false)) AS adjacent, min(lo) AS low, arg_max(coalesce(hi, -1), lo) AS high FROM w GROUP BY 1)
    SELECT o_custkey, adjacent, adjacent AND low = 1 AS at_least_one, adjacent AND high = 3 AS below_three FROM g""",
)
def wn04(spark, sf):
    lo = F.floor(F.col("o_totalprice") / 100000)
    band = F.struct(lo.alias("lo"), F.when(lo != 4, lo + 1).alias("hi"))
    # Distinct bands of a group are few: five price classes here.
    grouped = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.collect_set(band).alias("bands"))
    )
    return grouped.select(
        "o_custkey",
        B.adjacent_bands(F.col("bands")).alias("adjacent"),
        B.bands_match(F.col("bands"), F.lit(">="), F.lit("1")).alias("at_least_one"),
        B.bands_match(F.col("bands"), F.lit("<"), F.lit("3")).alias("below_three"),
    )


@query(
    "wn05_first_wins",
    "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2",
)
def wn05(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return Q.first_wins(rows, ["user_id", "event_type"], ["event_id"])


@query(
    "wn08_head_sample",
    "SELECT o_orderkey, o_totalprice, o_orderdate::DATE::VARCHAR AS day FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50",
)
def wn08(spark, sf):
    return (
        table(spark, sf, "orders")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(50)
        .select(
            "o_orderkey",
            "o_totalprice",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        )
    )


@query(
    "set01_bundle_union",
    """
    SELECT o_orderstatus AS package, o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice END AS price FROM orders""",
)
def set01(spark, sf):
    orders = table(spark, sf, "orders")
    parts = {}
    for status in ("F", "O", "P"):
        part = orders.filter(F.col("o_orderstatus") == status).select(
            "o_orderkey", F.col("o_totalprice").alias("price")
        )
        parts[status] = part if status == "F" else part.drop("price")
    return V.bundle_union(parts)


@query(
    "set01_build_bundle",
    f"""
    WITH {SQL_FACTS}, good AS (SELECT * FROM facts WHERE seg <> 'FURNITURE'),
    dup AS (SELECT count(*) AS n FROM good GROUP BY period_type, period_value, geography_level, geography_id, st, entity_name, seg, y, assertion,
      filing_status, agi_lower_usd, agi_upper_usd, eitc_child_count, income_range, trade_region HAVING count(*) > 1)
    SELECT 'package' AS part, source_name AS name, CASE seg WHEN 'FURNITURE' THEN 'failed' ELSE 'built' END AS key, count(*) AS n FROM facts GROUP BY ALL
    UNION ALL SELECT 'package_build_failed', 'bureau_furniture', 'assertion: enum', count(*) FROM facts WHERE seg = 'FURNITURE' AND pr = '1'
    UNION ALL SELECT 'package_without_rows', 'bureau_of_nothing', NULL, NULL
    UNION ALL SELECT 'duplicate_aggregate_fact_key', NULL, NULL, n FROM dup
    UNION ALL SELECT 'source', source_name, NULL, count(*) FROM good GROUP BY 2
    UNION ALL SELECT 'period', period_value, NULL, count(*) FROM good GROUP BY 2
    UNION ALL SELECT 'geography', geography_level, NULL, count(*) FROM good GROUP BY 2
    UNION ALL SELECT 'entity', entity_name, NULL, count(*) FROM good GROUP BY 2
    UNION ALL SELECT 'assertion', assertion, NULL, count(*) FROM good GROUP BY 2""",
)
def set01_build(spark, sf):
    """Facts to contract rows to a bundle; one package breaks the contract."""
    rows = P.consumer_rows(order_facts(spark, sf))
    package = F.col("source.source_name")
    spoil = (package == "bureau_furniture") & (F.col("entity.name") == "household")
    rows = rows.withColumn("assertion", F.when(spoil, "guess").otherwise(F.col("assertion")))
    lines = rows.select(package.alias("package"), BU.contract_json(rows).alias("text"))
    requested = lines.select("package").distinct().unionByName(
        spark.createDataFrame([("bureau_of_nothing",)], "package string")
    )
    bundle = BU.build_bundle(lines, requested)
    none = F.lit(None).cast("string")
    return (
        bundle.packages.select(F.lit("package").alias("part"), F.col("package").alias("name"), F.col("state").alias("key"), F.col("row_count").alias("n"))
        .unionByName(
            bundle.issues.filter("severity = 'error'").select(
                F.col("code").alias("part"), F.col("package").alias("name"), F.col("detail").alias("key"), "n"
            )
        )
        .unionByName(bundle.counts.select(F.col("dim").alias("part"), F.col("key").alias("name"), none.alias("key"), "n"))
    )


@query(
    "set02_key_sets",
    """
    WITH l AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), r AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT coalesce(l.k, r.k) AS o_custkey, CASE WHEN l.k IS NULL THEN 'right' WHEN r.k IS NULL THEN 'left' ELSE 'both' END AS side FROM l FULL JOIN r ON l.k = r.k""",
)
def set02(spark, sf):
    orders = table(spark, sf, "orders")
    return V.key_sets(
        orders.filter("o_orderstatus = 'F'"),
        orders.filter("o_orderpriority = '1-URGENT'"),
        "o_custkey",
    )


@query(
    "set03_availability",
    """
    WITH e AS (SELECT o_custkey, bool_and(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus <> 'F') AS skip FROM orders WHERE o_totalprice > 300000 GROUP BY 1)
    SELECT c_custkey AS package, CASE WHEN skip THEN 'skipped' ELSE 'build' END AS state, CASE WHEN skip THEN 'source package is not available for requested year' END AS reason
    FROM customer LEFT JOIN e ON c_custkey = o_custkey""",
)
def set03(spark, sf):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    errors = (
        table(spark, sf, "orders")
        .filter("o_totalprice > 300000")
        .select(
            F.col("o_custkey").alias("package"),
            F.when(urgent, "source_artifact_unavailable").otherwise("bad").alias("code"),
            F.when(F.col("o_orderstatus") == "O", "No source artifact for year 2023")
            .when(F.col("o_orderstatus") == "P", "'2023'")
            .otherwise("other")
            .alias("message"),
        )
    )
    packages = table(spark, sf, "customer").select(F.col("c_custkey").alias("package"))
    return V.availability(packages, errors, 2023)
