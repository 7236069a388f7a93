"""Queries for selectors, lookups, guards, regions and integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import regions as G
from factloom.operators import reshape as R
from factloom.operators import selectors as L
from factloom.operators import sequence as Q
from factloom.plans import targets as PT
from factloom.suite.registry import query, table


@query(
    "jn01_exactly_one",
    """
    WITH a AS (SELECT 's' || o_orderkey AS selector_id, o_orderkey, o_orderstatus, c_mktsegment, c_name FROM orders JOIN customer ON o_custkey = c_custkey),
    n AS (SELECT c_name, count(*) AS n, min(c_custkey) AS c_custkey FROM customer GROUP BY 1),
    b AS (SELECT c_mktsegment, c_nationkey, count(*) AS n, min(c_custkey) AS c_custkey FROM customer GROUP BY 1, 2),
    m AS (SELECT selector_id, coalesce(n.n, 0) AS match_count, n.c_custkey FROM a LEFT JOIN n ON n.c_name = a.c_name || CASE a.o_orderstatus WHEN 'P' THEN 'x' ELSE '' END
        WHERE o_orderstatus <> 'O'
      UNION ALL SELECT selector_id, coalesce(b.n, 0), b.c_custkey FROM a LEFT JOIN b ON b.c_mktsegment = a.c_mktsegment AND b.c_nationkey = a.o_orderkey % 50 WHERE o_orderstatus = 'O')
    SELECT selector_id, match_count, CASE WHEN match_count = 1 THEN c_custkey END AS c_custkey,
      CASE WHEN match_count <> 1 THEN 'selector_not_unique' END AS issue FROM m""",
)
def jn01(spark, sf):
    customers = table(spark, sf, "customer")
    orders = table(spark, sf, "orders").join(
        customers, F.expr("o_custkey = c_custkey")
    )
    status = F.col("o_orderstatus")
    nation = (F.col("o_orderkey") % 50).cast("string")
    criteria = F.when(
        status == "O",
        F.create_map(
            F.lit("c_mktsegment"), F.col("c_mktsegment"), F.lit("c_nationkey"), nation
        ),
    ).otherwise(
        F.create_map(
            F.lit("c_name"),
            F.concat("c_name", F.when(status == "P", "x").otherwise("")),
        )
    )
    selectors = orders.select(
        F.concat(F.lit("s"), "o_orderkey").alias("selector_id"), criteria.alias("criteria")
    )
    return L.select_exactly_one(
        selectors, customers, [["c_name"], ["c_mktsegment", "c_nationkey"]], "c_custkey"
    )


@query(
    "jn02_first_match",
    """
    WITH s AS (SELECT DISTINCT p_size * 100 + CAST(replace(p_brand, 'Brand#', '') AS INT) AS selector_no, p_size, p_brand FROM part),
    e AS (SELECT p_size, p_brand, min(p_partkey) AS p_partkey FROM part WHERE p_type <> 'PROMO' GROUP BY 1, 2)
    SELECT CAST(selector_no AS BIGINT) AS selector_no, p_partkey, 1 + row_number() OVER (ORDER BY selector_no) AS grid_row FROM s JOIN e USING (p_size, p_brand)""",
)
def jn02(spark, sf):
    part = table(spark, sf, "part")
    number = F.col("p_size") * 100 + F.replace(
        "p_brand", F.lit("Brand#"), F.lit("")
    ).cast("int")
    selectors = part.select(
        number.cast("bigint").alias("selector_no"),
        F.col("p_size").cast("string").alias("p_size"),
        "p_brand",
    ).distinct()
    return L.select_first(
        selectors, part.filter("p_type != 'PROMO'"), ["p_size", "p_brand"], "p_partkey"
    )


CELL_COLUMNS = ["p_name", "p_brand", "p_size", "p_retailprice"]


def part_cells(spark, sf):
    """Cells of ``part``: one sheet per type, the part key is the row."""
    rows = table(spark, sf, "part").select(
        F.col("p_type").alias("sheet"), F.col("p_partkey").alias("row"), *CELL_COLUMNS
    )
    return R.melt(rows, ["sheet", "row"], CELL_COLUMNS).withColumnRenamed(
        "position", "column"
    )


@query(
    "jn03_cell_lookup",
    """
    WITH s AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS r, CASE l_returnflag WHEN 'A' THEN 'ECONOMY' ELSE 'PROMO' END AS sheet,
      CASE l_linestatus WHEN 'F' THEN 3 ELSE 1 END AS c FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey, r, c::BIGINT AS c, CASE WHEN p_partkey IS NULL THEN NULL WHEN c = 3 THEN CAST(p_size AS VARCHAR) ELSE p_name END AS value,
      CASE WHEN p_partkey IS NULL THEN 'selector_did_not_match' WHEN c = 1 THEN 'unexpected_cell_kind' END AS issue
    FROM s LEFT JOIN part ON r = p_partkey AND sheet = p_type""",
)
def jn03(spark, sf):
    specs = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("l_partkey").alias("row"),
        F.when(F.col("l_returnflag") == "A", "ECONOMY").otherwise("PROMO").alias("sheet"),
        F.when(F.col("l_linestatus") == "F", 3).otherwise(1).cast("bigint").alias("column"),
        F.lit("number").alias("expected_kind"),
    )
    found = L.lookup_cells(
        specs, part_cells(spark, sf), ["sheet", "row", "column"], "expected_kind"
    )
    return found.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("row").alias("r"),
        F.col("column").alias("c"),
        F.col("value_text").alias("value"),
        "issue",
    )


@query(
    "jn04_row_ranges",
    """
    WITH r AS (SELECT s_suppkey AS range_id, s_suppkey * 3 AS a, s_suppkey * 3 + s_nationkey - 2 AS b, CASE WHEN s_nationkey > 20 THEN 1 ELSE 3 END AS c FROM supplier),
    j AS (SELECT range_id, count(p_partkey) AS found, sum(p_size) AS total FROM r LEFT JOIN part ON p_partkey BETWEEN a AND b AND p_type <> 'PROMO' GROUP BY 1)
    SELECT range_id, CASE WHEN b < a THEN 'inverted_range' WHEN found < b - a + 1 THEN 'missing_cell' WHEN c = 1 THEN 'nonnumeric_cell' END AS issue,
      CASE WHEN b >= a AND found = b - a + 1 AND c = 3 THEN CAST(total AS DOUBLE) END AS value FROM r JOIN j USING (range_id)""",
)
def jn04(spark, sf):
    ranges = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("range_id"),
        (F.col("s_suppkey") * 3).alias("row_from"),
        (F.col("s_suppkey") * 3 + F.col("s_nationkey") - 2).alias("row_to"),
        F.when(F.col("s_nationkey") > 20, 1).otherwise(3).cast("bigint").alias("column"),
    )
    gaps = part_cells(spark, sf).filter("sheet != 'PROMO'")
    return L.sum_row_ranges(ranges, gaps, ["column"])


SQL_GUARDS = """
guards AS (
  SELECT o_orderkey AS record_id, 'row header' AS guard, CASE WHEN p_type IS NULL THEN 'missing_guard_cell' WHEN o_orderstatus = 'P' THEN 'guard_mismatch' END AS issue
    FROM orders LEFT JOIN part ON o_custkey * 2 = p_partkey WHERE o_orderpriority <> '5-LOW'
  UNION ALL SELECT o_orderkey, 'column header', CASE WHEN p_type IS NULL THEN 'missing_guard_cell' WHEN p_size <> CAST(substr(o_orderpriority, 1, 1) AS INT) THEN 'guard_mismatch' END
    FROM orders LEFT JOIN part ON o_custkey * 2 = p_partkey)"""


def order_guards(spark, sf):
    """Two guards per order against the cells of one part row."""
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("_row"), F.col("p_name").alias("_name")
    )
    orders = (
        table(spark, sf, "orders")
        .withColumn("_row", F.col("o_custkey") * 2)
        .join(parts.hint(L.MERGED), "_row", "left")
    )
    digit = F.substring("o_orderpriority", 1, 1)
    skipped = F.col("o_orderpriority") == "5-LOW"
    none = F.lit(None)
    header = F.struct(
        F.lit("row header").alias("guard"),
        F.lit(1).cast("bigint").alias("column"),
        F.when(~skipped, "string").alias("expected_type"),
        F.when(F.col("o_orderstatus") == "P", "other")
        .otherwise(F.col("_name"))
        .alias("expected_text"),
        none.cast("double").alias("expected_num"),
    )
    size = F.struct(
        F.lit("column header").alias("guard"),
        F.lit(3).cast("bigint").alias("column"),
        F.lit("integer").alias("expected_type"),
        digit.alias("expected_text"),
        digit.cast("double").alias("expected_num"),
    )
    return orders.select(
        F.col("o_orderkey").alias("record_id"),
        F.col("_row").alias("row"),
        F.inline(F.array(header, size)),
    )


@query("jn05_guard_cells", f"WITH {SQL_GUARDS} SELECT * FROM guards")
def jn05(spark, sf):
    cells = part_cells(spark, sf).drop("sheet")
    return L.check_guards(order_guards(spark, sf), cells, ["row", "column"]).select(
        "record_id", "guard", "issue"
    )


@query(
    "jn05_guard_report",
    f"WITH {SQL_GUARDS} SELECT record_id, count(*) AS guard_count, count(issue) AS issue_count, count(issue) = 0 AS ok FROM guards GROUP BY 1",
)
def jn05_report(spark, sf):
    cells = part_cells(spark, sf).drop("sheet")
    return L.guard_report(
        L.check_guards(order_guards(spark, sf), cells, ["row", "column"])
    )


@query(
    "jn05_range_labels",
    """
    WITH p AS (SELECT p_partkey // 4 AS record_id, p_partkey, (p_partkey // 4) % 5 AS kind, count(*) OVER (PARTITION BY p_partkey // 4) AS k FROM part),
    f AS (SELECT *, CASE WHEN kind = 3 THEN 'no_end_address' WHEN kind = 1 OR k <> 4 THEN 'label_count' WHEN kind = 2 THEN 'null_label' END AS fault FROM p)
    SELECT record_id, p_partkey AS "row", CASE WHEN kind = 4 AND p_partkey % 4 = 0 THEN 'guard_mismatch' END AS issue FROM f WHERE fault IS NULL
    UNION ALL SELECT DISTINCT record_id, NULL, fault FROM f WHERE fault IS NOT NULL""",
)
def jn05_labels(spark, sf):
    """Four parts are a range whose names are its labels; four kinds are spoilt."""
    first = F.expr("p_partkey div 4")
    kind, low = F.col("record_id") % 5, F.col("p_partkey") == F.col("record_id") * 4
    name = (
        F.when((kind == 2) & low, F.lit(None))
        .when((kind == 4) & low, "other")
        .otherwise(F.col("p_name"))
    )
    label = F.struct(
        F.when(name.isNotNull(), "string").alias("type"),
        name.alias("text"),
        F.lit(None).cast("double").alias("num"),
    )
    # At most four labels per range, in the order of their rows.
    held = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "label"))), lambda r: r["label"])
    ranges = (
        table(spark, sf, "part")
        .withColumn("record_id", first)
        .withColumn("label", label)
        .groupBy("record_id")
        .agg(held.alias("_held"))
    )
    labels = ranges.select(
        "record_id",
        F.lit("names").alias("guard"),
        F.lit(1).cast("bigint").alias("column"),
        (F.col("record_id") * 4).alias("row_from"),
        F.when(kind != 3, F.col("record_id") * 4 + 3).alias("row_to"),
        F.when(kind == 1, F.slice("_held", 1, 3)).otherwise(F.col("_held")).alias("expected"),
    )
    cells = part_cells(spark, sf).drop("sheet")
    return L.check_range_labels(labels, cells).select("record_id", "row", "issue")


@query(
    "jn06_lineage_keys",
    """
    WITH p AS (SELECT l_orderkey AS record_id, 'part-' || l_partkey % 3 AS cell_key, min(l_linenumber) AS o FROM lineitem GROUP BY 1, 2
      UNION ALL SELECT DISTINCT l_orderkey, 'header', 1000 FROM lineitem)
    SELECT record_id, cell_key, row_number() OVER (PARTITION BY record_id ORDER BY o, cell_key) AS position FROM p""",
)
def jn06(spark, sf):
    lines = table(spark, sf, "lineitem")
    modulo = F.col("l_partkey") % 3
    # Line numbers repeat, so the key breaks ties inside the ordinal.
    values = lines.select(
        F.col("l_orderkey").alias("record_id"),
        (F.col("l_linenumber") * 10 + modulo).alias("ordinal"),
        F.concat(F.lit("part-"), modulo).alias("cell_key"),
    )
    headers = lines.select(
        F.col("l_orderkey").alias("record_id"),
        F.lit(10000).cast("bigint").alias("ordinal"),
        F.lit("header").alias("cell_key"),
    )
    return L.lineage_keys(values.unionByName(headers))


SQL_REGIONS = """
regions AS (SELECT CASE WHEN p_size = 7 THEN '' WHEN p_partkey % 5 = 0 THEN p_brand ELSE 'r' || p_partkey END AS region_id, p_partkey,
    CAST(p_size AS BIGINT) AS top_row, CAST(CASE WHEN p_size = 9 THEN 0 ELSE p_size - 1 END AS BIGINT) AS bottom_row,
    CAST(p_partkey % 9 + 1 AS BIGINT) AS left_column, CAST(p_partkey % 9 + 3 AS BIGINT) AS right_column FROM part),
cells AS (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS r, CAST(l_discount * 100 AS BIGINT) + 1 AS c FROM lineitem)"""


def region_tables(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    regions = table(spark, sf, "part").select(
        F.when(size == 7, "")
        .when(key % 5 == 0, F.col("p_brand"))
        .otherwise(F.concat(F.lit("r"), key.cast("string")))
        .alias("region_id"),
        size.alias("top_row"),
        F.when(size == 9, 0).otherwise(size + 2).cast("bigint").alias("bottom_row"),
        (key % 9 + 1).alias("left_column"),
        (key % 9 + 3).alias("right_column"),
    )
    cells = (
        table(spark, sf, "lineitem")
        .select(
            F.col("l_quantity").cast("bigint").alias("r"),
            (F.round(F.col("l_discount") * 100).cast("bigint") + 1).alias("c"),
        )
        .distinct()
    )
    return regions, cells


@query(
    "jn07_regions",
    """
    WITH regions AS (SELECT CASE WHEN p_size = 7 THEN '' WHEN p_partkey % 5 = 0 THEN p_brand ELSE 'r' || p_partkey END AS region_id,
      p_size AS t, CASE WHEN p_size = 9 THEN 0 ELSE p_size + 2 END AS b, p_partkey % 9 + 1 AS l, p_partkey % 9 + 3 AS rt FROM part),
    cells AS (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS r, CAST(round(l_discount * 100) AS BIGINT) + 1 AS c FROM lineitem),
    cov AS (SELECT region_id, count(DISTINCT r * 1000 + c) AS n FROM regions JOIN cells ON r BETWEEN t AND b AND c BETWEEN l AND rt GROUP BY 1),
    cp AS (SELECT region_id, count(*) AS copies FROM regions GROUP BY 1)
    SELECT region_id, coalesce(n, 0) AS covered_cells, CASE WHEN region_id = '' THEN 'missing_region_id' WHEN b < t THEN 'malformed_region_bounds'
      WHEN copies > 1 THEN 'duplicate_region_id' WHEN n IS NULL THEN 'region_matches_no_cells' END AS issue
    FROM regions JOIN cp USING (region_id) LEFT JOIN cov USING (region_id)""",
)
def jn07(spark, sf):
    regions, cells = region_tables(spark, sf)
    pairs = L.covering_regions(cells, regions, F.col("r"), F.col("c"))
    return L.region_report(regions, pairs, ["r", "c"])


SQL_GRID = """
cells AS (SELECT DISTINCT l_returnflag AS sheet, l_orderkey % 30000 + 1 AS r, l_suppkey + l_linenumber * 200 AS c FROM lineitem),
regions AS (SELECT p_partkey AS region_no, CASE WHEN p_size = 7 THEN ' ' WHEN p_partkey % 5 = 0 THEN p_brand ELSE 'r' || p_partkey END AS region_id,
  CASE WHEN p_partkey % 3 = 0 THEN 'A' WHEN p_partkey % 3 = 1 THEN 'N' ELSE 'none' END AS sheet,
  p_partkey * 7919 % 25000 - CASE WHEN p_size = 9 THEN 25000 ELSE 0 END AS t, p_partkey * 7919 % 25000 + p_size * p_size * p_size % 9000 AS b,
  p_partkey % 700 + 1 AS l, p_partkey % 700 + p_size * 20 AS rt FROM part),
sound AS (SELECT * FROM regions WHERE t >= 1),
pairs AS (SELECT region_no, s.sheet, r, c FROM sound s JOIN cells k ON s.sheet = k.sheet AND r BETWEEN t AND b AND c BETWEEN l AND rt),
cov AS (SELECT region_no, count(*) AS n FROM pairs GROUP BY 1)"""


@query(
    "jn07_region_suite",
    f"""
    WITH {SQL_GRID}
    SELECT region_no, region_id, coalesce(n, 0) AS covered_cells, NULL AS code FROM regions LEFT JOIN cov USING (region_no)
    UNION ALL SELECT region_no, region_id, NULL, 'missing_region_id' FROM regions WHERE region_id = ' '
    UNION ALL SELECT region_no, region_id, NULL, CASE WHEN t < 1 THEN 'malformed_region_bounds' ELSE 'region_matches_no_cells' END
      FROM regions LEFT JOIN cov USING (region_no) WHERE t < 1 OR n IS NULL
    UNION ALL SELECT NULL, region_id, NULL, 'duplicate_region_id' FROM regions GROUP BY region_id HAVING count(*) > 1
    UNION ALL SELECT NULL, NULL, count(*), NULL FROM (SELECT DISTINCT sheet, r, c FROM pairs)""",
)
def jn07_suite(spark, sf):
    cells = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("sheet"),
        (F.col("l_orderkey") % 30000 + 1).alias("r"),
        (F.col("l_suppkey") + F.col("l_linenumber") * 200).alias("c"),
    )
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    top = key * 7919 % 25000
    regions = table(spark, sf, "part").select(
        key.alias("region_no"),
        F.when(size == 7, " ").when(key % 5 == 0, F.col("p_brand")).otherwise(F.concat(F.lit("r"), key)).alias("region_id"),
        F.when(key % 3 == 0, "A").when(key % 3 == 1, "N").otherwise("none").alias("sheet"),
        (top - F.when(size == 9, 25000).otherwise(0)).alias("top_row"),
        (top + size * size * size % 9000).alias("bottom_row"),
        (key % 700 + 1).alias("left_column"),
        (key % 700 + size * 20).alias("right_column"),
    )
    counts, issues, total = G.region_suite(regions, cells, F.col("r"), F.col("c"), ["sheet"])
    empty = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return (
        counts.withColumn("code", F.lit(None).cast("string"))
        .unionByName(issues.withColumn("covered_cells", F.lit(None).cast("bigint")))
        .unionByName(
            total.select(empty("bigint", "region_no"), empty("string", "region_id"), "covered_cells", empty("string", "code"))
        )
    )


@query(
    "jn10_resolve_lineage",
    """
    WITH k AS (SELECT o_orderkey, unnest([o_custkey, o_custkey * 2]) AS c FROM orders WHERE o_orderstatus <> 'P'),
    u AS (SELECT o_orderkey, count(*) AS unresolved FROM k WHERE c NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1)
    SELECT o_orderkey, 'missing_lineage' AS issue, 0::BIGINT AS unresolved FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'unresolved_lineage', unresolved FROM u""",
)
def jn10(spark, sf):
    opened = F.col("o_orderstatus") == "P"
    keys = F.when(~opened, F.array("o_custkey", F.col("o_custkey") * 2)).otherwise(
        F.array().cast("array<bigint>")
    )
    facts = table(spark, sf, "orders").select("o_orderkey", keys.alias("keys"))
    known = table(spark, sf, "customer").filter("c_acctbal > 0")
    return L.resolve_lineage(facts, "o_orderkey", "keys", known.withColumnRenamed("c_custkey", "key"), "key")


@query(
    "jn11_referential_integrity",
    """
    SELECT 'lineitem.order' AS edge, count(*) AS dangling_rows, count(DISTINCT l_orderkey) AS dangling_keys FROM lineitem
      WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    UNION ALL SELECT 'lineitem.part', count(*), count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'orders.customer', count(*), count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL SELECT 'customer.nation', count(*), count(DISTINCT c_nationkey) FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""",
)
def jn11(spark, sf):
    t = lambda name: table(spark, sf, name)
    line, orders, customer = t("lineitem"), t("orders"), t("customer")
    return L.dangling_references(
        [
            ("lineitem.order", line, "l_orderkey", orders.filter("o_orderstatus != 'P'"), "o_orderkey"),
            ("lineitem.part", line, "l_partkey", t("part"), "p_partkey"),
            ("orders.customer", orders, "o_custkey", customer.filter("c_acctbal > 0"), "c_custkey"),
            ("customer.nation", customer, "c_nationkey", t("supplier").filter("s_acctbal > 5000"), "s_nationkey"),
        ]
    )


@query(
    "jn13_label_lookup",
    """
    WITH l AS (SELECT DISTINCT p_brand || ' ' || p_type AS label FROM part),
    r AS (SELECT p_brand || ' ' || p_type AS label, p_partkey, p_retailprice FROM part WHERE p_size < 20),
    f AS (SELECT label, min(p_partkey) AS row_number, arg_min(p_retailprice, p_partkey) AS value FROM r GROUP BY 1)
    SELECT label, row_number, value, CASE WHEN row_number IS NULL THEN 'missing_label' END AS issue FROM l LEFT JOIN f USING (label)""",
)
def jn13(spark, sf):
    part = table(spark, sf, "part")
    labels = part.select(F.concat_ws(" ", "p_brand", "p_type").alias("label")).distinct()
    raw = F.concat(F.lit("  "), "p_brand", F.lit("\n  "), "p_type", F.lit(" "))
    return L.first_by_label(
        labels,
        part.filter("p_size < 20"),
        S.clean_space(raw),
        "p_partkey",
        F.col("p_retailprice"),
    )


@query(
    "jn14_sections",
    """
    WITH s AS (SELECT user_id, min(event_id) AS a FROM events WHERE event_type = 'signup' GROUP BY 1),
    e AS (SELECT ev.user_id, min(event_id) AS b FROM events ev JOIN s ON s.user_id = ev.user_id WHERE event_type = 'error' AND event_id > a GROUP BY 1)
    SELECT ev.user_id, event_id, event_type FROM events ev JOIN s ON s.user_id = ev.user_id LEFT JOIN e ON e.user_id = ev.user_id
    WHERE event_id >= a AND (b IS NULL OR event_id < b)""",
)
def jn14(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    kind = F.col("event_type")
    return Q.sections(rows, ["user_id"], "event_id", kind == "signup", kind == "error")


@query(
    "jn15_find_column",
    """
    WITH h AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS col, lower(string_agg(event_type, ' ' ORDER BY event_id)) AS header
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 ORDER BY event_id) AS n FROM events)
      WHERE n <= 8 GROUP BY 1, 2)
    SELECT user_id, min(col) AS "column" FROM h WHERE contains(header, 'signup') AND contains(header, 'error') GROUP BY 1""",
)
def jn15(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id",
        "event_id",
        (F.regexp_extract("props", "([0-9]+)", 1).cast("bigint") % 10).alias("column"),
        F.col("event_type").alias("label"),
    )
    cells = Q.number_rows(events, ["user_id", "column"], "event_id", "row")
    return L.find_column(cells, ["user_id"], ["Signup", "error"])


@query(
    "jn21_registry_drift",
    """
    WITH a AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 3000), b AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal < 1000)
    SELECT coalesce(a.k, b.k) AS entry, CASE WHEN a.k IS NULL THEN 'unmapped' ELSE 'missing' END AS drift
    FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""",
)
def jn21(spark, sf):
    declared = table(spark, sf, "supplier").filter("s_acctbal > 3000")
    present = table(spark, sf, "customer").filter("c_acctbal < 1000")
    return PT.registry_drift(
        declared.select(F.col("s_nationkey").alias("entry")),
        present.select(F.col("c_nationkey").alias("entry")),
        "entry",
    )


@query(
    "jn22_required_coverage",
    """
    WITH r AS (SELECT DISTINCT unnest(['k' || o_custkey, 'p' || (o_orderkey % 97)]) AS alias FROM orders WHERE o_orderstatus = 'F')
    SELECT alias FROM r WHERE alias NOT IN (SELECT 'k' || c_custkey FROM customer WHERE c_acctbal > 0) AND alias NOT IN (SELECT 'p' || (p_partkey % 90) FROM part)""",
)
def jn22(spark, sf):
    entries = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("role"),
        F.array(
            F.concat(F.lit("k"), "o_custkey"),
            F.concat(F.lit("p"), (F.col("o_orderkey") % 97)),
        ).alias("aliases"),
    )
    registry = (
        table(spark, sf, "customer")
        .filter("c_acctbal > 0")
        .select(F.concat(F.lit("k"), "c_custkey").alias("alias"))
        .unionByName(
            table(spark, sf, "part").select(
                F.concat(F.lit("p"), (F.col("p_partkey") % 90)).alias("alias")
            )
        )
    )
    return PT.missing_coverage(entries, "F", registry)
