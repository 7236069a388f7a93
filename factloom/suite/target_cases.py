"""Queries for targets, strata, loads and work items."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import coverage as V
from factloom.plans import targets as PT
from factloom.plans import workitems as PW
from factloom.suite.fact_base import SQL_FACTS, order_facts
from factloom.suite.registry import query, table


def money(name):
    return F.col(name).cast("decimal(18,2)")


@query(
    "jn09_targets_at_level",
    """
    SELECT p_partkey, p_type FROM part WHERE p_type NOT IN ('PROMO') AND p_size > 10""",
)
def jn09(spark, sf):
    levels = F.when(
        F.col("p_type") == "PROMO", F.array(F.lit("country"))
    ).otherwise(
        F.when(F.col("p_size") > 10, F.array(F.lit("country"), F.lit("state"))).otherwise(
            F.array().cast("array<string>")
        )
    )
    targets = table(spark, sf, "part").select(
        "p_partkey", "p_type", levels.alias("geography_levels")
    )
    return PT.at_level(targets, "state").drop("geography_levels")


MEASURES = [
    ("us.trade.building", "building_sales", "amount", "usd"),
    ("us.trade.furniture", "furniture_sales", "amount", "usd"),
    ("us.trade.household", "household_sales", "count", "usd"),
]


@query(
    "jn12_measured_targets",
    f"""
    WITH {SQL_FACTS} SELECT seq, geography_id, lseg || '_sales' AS variable, CASE lseg WHEN 'household' THEN 'count' ELSE 'amount' END AS target_type, value_num
    FROM facts WHERE geography_level = 'state' AND lseg IN ('building', 'furniture', 'household')""",
)
def jn12(spark, sf):
    return PT.measured_targets(order_facts(spark, sf), MEASURES, "state").select(
        "seq",
        F.col("geography.id").alias("geography_id"),
        "variable",
        "target_type",
        "value_num",
    )


def star(spark, sf):
    """Orders as targets, customers as strata with two constraints each."""
    targets = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("stratum_id"),
        F.col("o_orderpriority").alias("variable"),
        F.year("o_orderdate").cast("bigint").alias("period"),
        F.col("o_orderstatus").alias("source"),
        F.col("o_totalprice").alias("value"),
    )
    strata = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .select(
            F.col("c_custkey").alias("stratum_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("jurisdiction"),
            "c_mktsegment",
        )
    )
    terms = F.array(
        PT.term("segment", "==", F.col("c_mktsegment")),
        PT.term("nation", "==", F.col("jurisdiction")),
    )
    constraints = strata.select("stratum_id", F.inline(terms))
    return targets, strata.drop("c_mktsegment"), constraints


@query(
    "jn16_nested_targets",
    """
    SELECT o_orderkey, c_name AS name, n_name AS jurisdiction, CAST(year(o_orderdate) AS BIGINT) AS period,
      'nation==' || n_name || ',segment==' || c_mktsegment AS constraints
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def jn16(spark, sf):
    nested = PT.nested_targets(*star(spark, sf))
    texts = F.transform(
        "constraints",
        lambda item: F.concat(item["variable"], item["operator"], item["value"]),
    )
    return nested.select(
        "o_orderkey",
        "name",
        "jurisdiction",
        "period",
        F.array_join(texts, ",").alias("constraints"),
    )


@query(
    "jn17_find_targets",
    """
    SELECT o_orderkey, c_name AS name, o_totalprice AS value FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderpriority = '2-HIGH' AND year(o_orderdate) = 1997 ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""",
)
def jn17(spark, sf):
    targets, strata, _ = star(spark, sf)
    order = [F.desc("value"), "o_orderkey"]
    return PT.find_targets(
        targets, strata, order, 50, variable="2-HIGH", period=1997, source=None
    ).select("o_orderkey", "name", "value")


@query(
    "jn18_insert_if_absent",
    """
    WITH s AS (SELECT o_orderkey, o_custkey, o_orderpriority, year(o_orderdate) AS y FROM orders WHERE o_orderstatus = 'F'),
    l AS (SELECT min(o_orderkey) AS o_orderkey, o_custkey, o_orderpriority, year(o_orderdate) AS y FROM orders WHERE o_orderstatus <> 'F' GROUP BY 2, 3, 4)
    SELECT o_orderkey, o_custkey, o_orderpriority, CAST(y AS INTEGER) AS y FROM (SELECT * FROM s UNION ALL SELECT l.* FROM l
      WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_custkey = l.o_custkey AND s.o_orderpriority = l.o_orderpriority AND s.y = l.y))""",
)
def jn18(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.year("o_orderdate").alias("y"),
        "o_orderstatus",
    )
    stored = rows.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    loaded = rows.filter("o_orderstatus != 'F'").drop("o_orderstatus")
    return PT.insert_if_absent(
        stored, loaded, ["o_custkey", "o_orderpriority", "y"], "o_orderkey"
    )


SQL_STRATUM = r"""substr(sha256('jurisdiction=' || {0} || '|constraints=' ||
  replace(replace(replace('variable=nation|operator===|value=' || {1}, '|', '\|') || '|' || replace('variable=segment|operator===|value=' || {2}, '|', '\|'), '\', '\\'), '|', '\|')), 1, 16)"""


@query(
    "jn19_get_or_create_strata",
    f"""
    WITH a AS (SELECT o_orderkey AS seq, r_name, n_name, c_mktsegment, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    h AS (SELECT {SQL_STRATUM.format('r_name', 'n_name', 'c_mktsegment')} AS definition_hash, seq, CASE WHEN o_orderstatus = 'F' THEN 'stored ' ELSE 'loaded ' END || seq AS name,
      CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS rank FROM a)
    SELECT definition_hash, arg_min(name, rank * 1000000000 + seq) AS name, 2 AS n_terms FROM h GROUP BY 1""",
)
def jn19(spark, sf):
    rows = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
        .select(
            F.col("o_orderkey").alias("seq"),
            F.col("r_name").alias("jurisdiction"),
            F.array(
                PT.term("segment", "==", F.col("c_mktsegment")),
                PT.term("nation", "==", F.col("n_name")),
            ).alias("constraints"),
            (F.col("o_orderstatus") == "F").alias("is_stored"),
        )
    )

    def named(stored, prefix):
        part = rows.filter("is_stored" if stored else "NOT is_stored").drop("is_stored")
        return part.withColumn("name", F.concat(F.lit(prefix), F.col("seq")))

    strata = PT.get_or_create_strata(named(True, "stored "), named(False, "loaded "))
    terms = PT.stratum_terms(strata).groupBy("definition_hash").agg(
        F.count("*").cast("int").alias("n_terms")
    )
    return strata.join(terms, "definition_hash").select(
        "definition_hash", "name", "n_terms"
    )


@query(
    "jn20_fallback_lookup",
    """
    SELECT o_orderkey, coalesce(s_name, n_name, p_name) AS package, CASE WHEN s_name IS NOT NULL THEN 'url' WHEN n_name IS NOT NULL THEN 'notes'
      WHEN p_name IS NOT NULL THEN 'filename' END AS basis
    FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey LEFT JOIN nation ON n_nationkey = o_orderkey % 60 LEFT JOIN part ON p_partkey = o_orderkey""",
)
def jn20(spark, sf):
    items = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderkey") % 60).alias("note_id")
    )
    t = lambda name, value: table(spark, sf, name).withColumnRenamed(value, "package")
    return PT.fallback_lookup(
        items,
        [
            ("url", t("supplier", "s_name"), "o_custkey", "s_suppkey"),
            ("notes", t("nation", "n_name"), "note_id", "n_nationkey"),
            ("filename", t("part", "p_name"), "o_orderkey", "p_partkey"),
        ],
        "package",
    ).select("o_orderkey", "package", "basis")


def order_values(spark, sf):
    """Orders as published facts with an empty derivation."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderstatus") == "F", "sales").alias("variable"),
        F.col("o_totalprice").alias("value"),
        F.year("o_orderdate").cast("bigint").alias("period"),
        F.lit("usd").alias("unit"),
        PT.no_steps().alias("steps"),
    )


@query(
    "pt03_scale_and_convert",
    """
    SELECT o_orderkey, round(o_totalprice * 0.5 * 100.0, 6) AS value, 'cents' AS unit,
      'scale_value(factor=0.5, input_unit=usd, output_unit=usd, note=halved); convert_units(factor=100.0, input_unit=usd, output_unit=cents)' AS steps FROM orders""",
)
def pt03(spark, sf):
    halved = PT.scale_facts(order_values(spark, sf), 0.5, note="halved")
    return PT.convert_units(halved, 100.0, "cents").select(
        "o_orderkey",
        F.round("value", 6).alias("value"),
        "unit",
        PT.format_steps(F.col("steps")).alias("steps"),
    )


@query(
    "pt04_apply_shares",
    """
    WITH t AS (SELECT n_name AS name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
    c AS (SELECT n_name AS name, c_mktsegment AS share_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    s AS (SELECT name, share_name, n::DOUBLE / (sum(n) OVER (PARTITION BY name))::DOUBLE AS share FROM c)
    SELECT name, share_name, CAST(trunc(value * share) AS DOUBLE) AS value, 1 AS n_steps FROM t JOIN s USING (name)""",
)
def pt04(spark, sf):
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    totals = (
        table(spark, sf, "orders")
        .join(customers, F.expr("o_custkey = c_custkey"))
        .groupBy(F.col("n_name").alias("name"))
        .agg(F.sum(money("o_totalprice")).cast("double").alias("value"))
        .withColumn("steps", PT.no_steps())
    )
    counts = customers.groupBy(
        F.col("n_name").alias("name"), F.col("c_mktsegment").alias("share_name")
    ).agg(F.count("*").alias("n"))
    sizes = customers.groupBy(F.col("n_name").alias("name")).agg(F.count("*").alias("all"))
    shares = counts.join(sizes, "name").select(
        "name", "share_name", (F.col("n") / F.col("all")).alias("share")
    )
    return PT.apply_shares(totals, shares, ["name"], whole=True).select(
        "name", "share_name", "value", F.size("steps").alias("n_steps")
    )


@query(
    "pt05_as_targets",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS stratum_hash, CASE WHEN o_orderstatus = 'F' THEN 'sales' ELSE o_orderpriority END AS variable,
      CAST(year(o_orderdate) AS BIGINT) AS period, round(o_totalprice * 2.0, 6) AS value, 'amount' AS target_type, 'state' AS geographic_level,
      CASE WHEN o_orderstatus = 'O' THEN 'as published ' ELSE '' END || 'Derived via: convert_units(factor=2.0, input_unit=usd, output_unit=halves).' AS notes,
      false AS is_preliminary FROM orders""",
)
def pt05(spark, sf):
    status = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", "as published")
        .when(F.col("o_orderstatus") == "P", "")
        .alias("notes"),
    )
    facts = PT.convert_units(order_values(spark, sf), 2.0, "halves").join(
        status, "o_orderkey"
    )
    shaped = facts.withColumns(
        {
            "stratum_hash": F.col("o_orderkey").cast("string"),
            "source": F.lit("orders"),
            "is_preliminary": F.lit(None).cast("boolean"),
        }
    )
    return (
        PT.as_targets(shaped, "amount", "state")
        .withColumn("value", F.round("value", 6))
        .drop("source")
    )


@query(
    "pt06_allocate_brackets",
    """
    WITH t AS (SELECT n_name, year(o_orderdate) AS y, count(*) AS r, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS i, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 4 AS x
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    b(bracket, a, b, c) AS (VALUES ('under_1', 0.02::DOUBLE, 0.00::DOUBLE, 0.00::DOUBLE), ('1_to_10k', 0.12, 0.01, 0.00), ('10k_to_25k', 0.15, 0.03, 0.01), ('25k_to_50k', 0.18, 0.08, 0.04),
      ('50k_to_75k', 0.14, 0.10, 0.06), ('75k_to_100k', 0.11, 0.10, 0.08), ('100k_to_200k', 0.17, 0.22, 0.20), ('200k_to_500k', 0.08, 0.18, 0.22),
      ('500k_to_1m', 0.02, 0.10, 0.14), ('1m_plus', 0.01, 0.18, 0.25))
    SELECT n_name, CAST(y AS INTEGER) AS y, bracket, CAST(trunc(r * a) AS BIGINT) AS returns, CAST(trunc(i * b) AS BIGINT) AS income, CAST(trunc(x * c) AS BIGINT) AS tax FROM t, b""",
)
def pt06(spark, sf):
    totals = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .groupBy("n_name", F.year("o_orderdate").alias("y"))
        .agg(
            F.count("*").alias("total_returns"),
            F.sum(money("o_totalprice")).cast("double").alias("total_income"),
        )
        .withColumn("total_tax", F.col("total_income") / 4)
    )
    return PT.allocate_brackets(totals, ["n_name", "y"])


@query(
    "pt07_load_targets",
    f"""
    WITH w AS (SELECT r_name, n_name, c_mktsegment, year(o_orderdate) AS y, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS s,
        max(CASE WHEN o_orderstatus = 'F' AND o_totalprice > 400000 THEN o_totalprice END) AS m
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
    h AS (SELECT *, {SQL_STRATUM.format('r_name', 'n_name', 'c_mktsegment')} AS stratum_hash FROM w)
    SELECT stratum_hash, CAST(y AS BIGINT) AS period, 'order_count' AS variable, 'count' AS target_type, CAST(n AS DOUBLE) AS value FROM h
    UNION ALL SELECT stratum_hash, y, 'order_total', 'amount', s FROM h
    UNION ALL SELECT stratum_hash, y, 'largest_final', 'amount', m FROM h WHERE m IS NOT NULL""",
)
def pt07(spark, sf):
    large = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)
    wide = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
        .groupBy("r_name", "n_name", "c_mktsegment", F.year("o_orderdate").alias("y"))
        .agg(
            F.count("*").alias("n"),
            F.sum(money("o_totalprice")).alias("s"),
            F.max(F.when(large, F.col("o_totalprice"))).alias("m"),
        )
    )
    constraints = F.array(
        PT.term("nation", "==", F.col("n_name")),
        PT.term("segment", "==", F.col("c_mktsegment")),
    )
    return PT.load_targets(
        wide,
        [
            ("n", "order_count", "count"),
            ("s", "order_total", "amount"),
            ("m", "largest_final", "amount"),
        ],
        constraints,
        F.col("r_name"),
        "y",
    )


def sql_tree_hash(*terms):
    texts = sorted(terms)
    inner = " || '|' || ".join(
        f"replace('variable={variable}|operator===|value=' || {column}, '|', '\\|')"
        for variable, column in texts
    )
    return (
        f"substr(sha256('jurisdiction=world|constraints=' || "
        rf"replace(replace({inner}, '\', '\\'), '|', '\|')), 1, 16)"
    )


_H1 = sql_tree_hash(("region", "r_name"))
_H2 = sql_tree_hash(("region", "r_name"), ("nation", "n_name"))
_H3 = sql_tree_hash(("region", "r_name"), ("nation", "n_name"), ("segment", "c_mktsegment"))


@query(
    "pt08_strata_tree",
    f"""
    WITH l AS (SELECT DISTINCT r_name, n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT DISTINCT 1 AS depth, r_name AS name, {_H1} AS definition_hash, NULL AS parent_hash, 1 AS n_terms FROM l
    UNION ALL SELECT DISTINCT 2, r_name || ' / ' || n_name, {_H2}, {_H1}, 2 FROM l
    UNION ALL SELECT 3, r_name || ' / ' || n_name || ' / ' || c_mktsegment, {_H3}, {_H2}, 3 FROM l""",
)
def pt08(spark, sf):
    leaves = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    levels = [("r_name", "region"), ("n_name", "nation"), ("c_mktsegment", "segment")]
    tree = PT.strata_tree(leaves, levels, "world")
    return tree.select(
        "depth",
        "name",
        "definition_hash",
        "parent_hash",
        F.size("constraints").alias("n_terms"),
    )


SQL_ITEMS = """
items0 AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'row_parsed' WHEN '2-HIGH' THEN 'fetch_error' WHEN '3-MEDIUM' THEN 'deferred'
      WHEN '4-NOT SPECIFIED' THEN 'not_started' ELSE 'source_package' END AS source_status, '' AS dummy,
    CASE WHEN o_totalprice < 100000 THEN 'fred' ELSE 'irs' END AS source_id,
    CASE o_orderstatus WHEN 'F' THEN 'url' ELSE 'file' END AS artifact_kind, CASE o_orderstatus WHEN 'O' THEN 'yes' ELSE 'no' END AS exists_locally,
    ['.xlsx', '.csv', '.pdf', '.zip'][o_custkey % 4 + 1] AS format,
    ['snap-source-documents', 'local-geography-source-documents', 'national-soi-workbooks', 'other'][o_custkey % 5 % 4 + 1] AS pipeline,
    CASE WHEN o_custkey % 3 = 0 THEN 'publisher_source' ELSE 'copy' END AS artifact_role,
    CASE WHEN o_orderstatus = 'F' THEN 'cells_missing' ELSE '' END AS cell_status FROM orders),
items1 AS (SELECT *, CASE source_status WHEN 'deferred' THEN 'blocked_or_deferred' WHEN 'source_package' THEN 'existing_source_package' WHEN 'row_parsed' THEN 'source_cell_scaffold'
    WHEN 'fetch_error' THEN 'repair_artifact_ingest' ELSE CASE WHEN source_id = 'fred' THEN 'find_primary_source' WHEN artifact_kind = 'url' THEN 'fetch_artifact'
    WHEN exists_locally = 'yes' THEN 'register_local_artifact' ELSE 'blocked_missing_local_artifact' END END AS stage FROM items0),
items AS (SELECT *, CASE WHEN stage = 'existing_source_package' THEN 105 WHEN stage = 'blocked_or_deferred' THEN 10 WHEN stage = 'find_primary_source' THEN 75
    WHEN source_id = 'fred' THEN 70 WHEN pipeline LIKE 'local%' THEN 20 WHEN pipeline LIKE 'national%' THEN 100
    WHEN stage = 'source_cell_scaffold' AND artifact_role = 'publisher_source' THEN 95 WHEN pipeline LIKE 'snap%' THEN 90 WHEN format = '.xlsx' THEN 85
    WHEN format = '.csv' THEN 80 WHEN format = '.pdf' THEN 70 WHEN stage = 'source_cell_scaffold' THEN 65 ELSE 50 END AS priority FROM items1)"""


# --- fixed values: the rule tables of the source inventory --------------------
AGGREGATOR = {"source_id": ["fred"]}
BULK = {"pipeline": ["local-geography-source-documents"]}
PIPELINES = [
    "national-soi-workbooks",
    "cbo-source-documents",
    "snap-source-documents",
    "tanf-source-documents",
    "medicaid-source-documents",
    "tax-expenditure-source-documents",
    "health-source-documents",
    "ssa-source-documents",
    "macro-source-documents",
    "medicare-source-documents",
]
STAGES = [
    ("existing_source_package", {"existing_package": None}),
    ("blocked_or_deferred", {"source_status": ["blocked", "deferred"]}),
    ("existing_source_package", {"source_status": ["source_package"]}),
    ("source_cell_scaffold", {"source_status": ["row_parsed"]}),
    (
        "repair_artifact_ingest",
        {"source_status": ["fetch_error", "identity_mismatch", "parsed_no_rows"]},
    ),
    ("find_primary_source", AGGREGATOR),
    ("fetch_artifact", {"artifact_kind": ["url"]}),
    ("register_local_artifact", {"exists_locally": ["yes"]}),
    ("blocked_missing_local_artifact", {}),
]
SCAFFOLD = {"stage": ["source_cell_scaffold"]}
PRIORITIES = [
    (105, {"stage": ["existing_source_package"]}),
    (10, {"stage": ["blocked_or_deferred"]}),
    (75, {"stage": ["find_primary_source"]}),
    (70, AGGREGATOR),
    (20, BULK),
    (100, {"pipeline": PIPELINES[:1]}),
    (95, {**SCAFFOLD, "artifact_role": ["publisher_source"]}),
    (90, {"pipeline": PIPELINES}),
    (85, {"format": [".xls", ".xlsx", ".ods"]}),
    (80, {"format": [".csv", ".csv.gz", ".json", ".txt"]}),
    (70, {"format": [".html", ".pdf"]}),
    (65, SCAFFOLD),
    (50, {}),
]
BLOCKERS = [
    ("publisher_source_required", {"stage": ["find_primary_source"]}),
    ("publisher_not_identified", {"stage": ["find_primary_source"], "no_publisher": [True]}),
    ("bulk_local_geography_source", BULK),
    ("needs_format_specific_source_cell_parser", {**SCAFFOLD, "format": [".zip", ".pdf"]}),
    ("local_artifact_missing", {"stage": ["blocked_missing_local_artifact"]}),
    (("column", "source_status"), {"stage": ["repair_artifact_ingest"]}),
    (("column", "source_status"), {"stage": ["blocked_or_deferred"]}),
    (("column", "cell_status"), {"stage": ["blocked_or_deferred"], "cell_status": None}),
]
# ------------------------------------------------------------------------------


def work_items(spark, sf):
    cust, status = F.col("o_custkey"), F.col("o_orderstatus")
    order_priority = F.col("o_orderpriority")

    def choose(position, *values):
        return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))

    items = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(order_priority == "1-URGENT", "row_parsed")
        .when(order_priority == "2-HIGH", "fetch_error")
        .when(order_priority == "3-MEDIUM", "deferred")
        .when(order_priority == "4-NOT SPECIFIED", "not_started")
        .otherwise("source_package")
        .alias("source_status"),
        F.lit(None).cast("string").alias("existing_package"),
        F.when(F.col("o_totalprice") < 100000, "fred").otherwise("irs").alias("source_id"),
        F.when(status == "F", "url").otherwise("file").alias("artifact_kind"),
        F.when(status == "O", "yes").otherwise("no").alias("exists_locally"),
        choose(cust % 4, ".xlsx", ".csv", ".pdf", ".zip").alias("format"),
        choose(
            cust % 5 % 4,
            "snap-source-documents",
            "local-geography-source-documents",
            "national-soi-workbooks",
            "other",
        ).alias("pipeline"),
        F.when(cust % 3 == 0, "publisher_source").otherwise("copy").alias("artifact_role"),
        F.when(status == "F", "cells_missing").otherwise("").alias("cell_status"),
        F.when(status == "O", "bea").alias("publisher"),
    )
    items = items.withColumn("no_publisher", F.col("publisher").isNull())
    items = PW.classify(items, STAGES, PRIORITIES, BLOCKERS)
    return items.drop("no_publisher")


@query(
    "pt09_stage_and_priority",
    f"""
    WITH {SQL_ITEMS} SELECT o_orderkey, stage, CAST(priority AS INTEGER) AS priority, concat_ws(',', CASE WHEN stage = 'find_primary_source' THEN 'publisher_source_required' END,
      CASE WHEN stage = 'find_primary_source' AND exists_locally = 'no' THEN 'publisher_not_identified' END,
      CASE WHEN pipeline LIKE 'local%' THEN 'bulk_local_geography_source' END,
      CASE WHEN format IN ('.zip', '.pdf') AND stage = 'source_cell_scaffold' THEN 'needs_format_specific_source_cell_parser' END,
      CASE WHEN stage = 'blocked_missing_local_artifact' THEN 'local_artifact_missing' END, CASE WHEN stage = 'repair_artifact_ingest' THEN source_status END,
      CASE WHEN stage = 'blocked_or_deferred' THEN source_status END, CASE WHEN stage = 'blocked_or_deferred' THEN nullif(cell_status, '') END) AS blockers FROM items""",
)
def pt09(spark, sf):
    return work_items(spark, sf).select(
        "o_orderkey", "stage", "priority", F.array_join("blockers", ",").alias("blockers")
    )


SQL_BATCHES = f"""{SQL_ITEMS}, numbered AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY -priority, pipeline, o_orderkey) AS no FROM items),
batched AS (SELECT *, 'plan-' || stage || '-' || CASE WHEN (no - 1) // 100 + 1 > 999 THEN CAST((no - 1) // 100 + 1 AS VARCHAR) ELSE lpad(CAST((no - 1) // 100 + 1 AS VARCHAR), 3, '0') END AS batch_id FROM numbered)"""


@query(
    "wn06_batches",
    f"""
    WITH {SQL_BATCHES} SELECT stage, batch_id, count(*) AS item_count, CAST(min(priority) AS INTEGER) AS priority_min, CAST(max(priority) AS INTEGER) AS priority_max, CAST(sum(o_orderkey) AS BIGINT) AS checksum
    FROM batched GROUP BY 1, 2""",
)
def wn06(spark, sf):
    batched = PW.batches(work_items(spark, sf), "o_orderkey", ["pipeline"], 100, "plan")
    sums = batched.groupBy("batch_id").agg(F.sum("o_orderkey").alias("checksum"))
    return PW.batch_report(batched).join(sums, "batch_id")


@query(
    "ag13_most_common",
    f"""
    WITH {SQL_ITEMS} SELECT dim, key, n, row_number() OVER (PARTITION BY dim ORDER BY n DESC, key) AS rank FROM (
      SELECT 'artifact_role' AS dim, artifact_role AS key, count(*) AS n FROM items GROUP BY 2 UNION ALL SELECT 'source_status', source_status, count(*) FROM items GROUP BY 2
      UNION ALL SELECT 'format', format, count(*) FROM items GROUP BY 2 UNION ALL SELECT 'pipeline', pipeline, count(*) FROM items GROUP BY 2
      UNION ALL SELECT 'stage', stage, count(*) FROM items GROUP BY 2
      UNION ALL SELECT 'publisher', CASE exists_locally WHEN 'yes' THEN 'bea' ELSE 'missing' END, count(*) FROM items GROUP BY 2)""",
)
def ag13(spark, sf):
    items = work_items(spark, sf)
    names = ["artifact_role", "source_status", "format", "pipeline", "stage"]
    dims = {name: F.col(name) for name in names}
    dims["publisher"] = F.coalesce("publisher", F.lit("missing"))
    return V.most_common(V.counts_by(items, dims))


@query(
    "pt10_category_terms",
    """
    WITH c AS (SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '0_children' WHEN '2' THEN '1_child' WHEN '3' THEN '2_children' WHEN '4' THEN '3plus_children' ELSE 'unknown' END AS category FROM orders)
    SELECT category, count(*) AS n, CASE category WHEN '3plus_children' THEN '>=' WHEN 'unknown' THEN NULL ELSE '==' END AS operator,
      CASE category WHEN '0_children' THEN '0' WHEN '1_child' THEN '1' WHEN '2_children' THEN '2' WHEN '3plus_children' THEN '3' END AS value FROM c GROUP BY 1""",
)
def pt10(spark, sf):
    digit = F.substring("o_orderpriority", 1, 1)
    category = (
        F.when(digit == "1", "0_children")
        .when(digit == "2", "1_child")
        .when(digit == "3", "2_children")
        .when(digit == "4", "3plus_children")
        .otherwise("unknown")
    )
    return (
        table(spark, sf, "orders")
        .groupBy(category.alias("category"))
        .agg(F.count("*").alias("n"))
        .withColumn("t", PT.category_terms(F.col("category"), "children"))
        .select("category", "n", "t.operator", "t.value")
    )
