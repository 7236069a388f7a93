"""Queries for the reshaping operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import keys as K
from factloom.functions import scalars as S
from factloom.operators import reshape as R
from factloom.operators import sequence as Q
from factloom.suite.registry import query, sql_digest, sql_record, table

PART_COLUMNS = {
    "p_partkey": "integer",
    "p_name": "string",
    "p_brand": "string",
    "p_size": "integer",
    "p_retailprice": "number",
}


def sql_melt(columns, source, keep):
    parts = []
    for position, (name, kind) in enumerate(columns.items(), 1):
        number = f"CAST({name} AS DOUBLE)" if kind != "string" else "NULL::DOUBLE"
        tag = "text" if kind == "string" else "number"
        parts.append(
            f"SELECT {keep}, {position}::BIGINT AS position, '{name}' AS raw_name, '{kind}' AS value_type, "
            f"CAST({name} AS VARCHAR) AS value_text, {number} AS value_num, '{tag}' AS kind FROM {source}"
        )
    return " UNION ALL ".join(parts)


@query(
    "prj01_melt",
    f"SELECT k, position, raw_name, raw_name AS column_name, value_type, value_text, value_num, kind "
    f"FROM ({sql_melt(PART_COLUMNS, 'part', 'p_partkey AS k')})",
)
def prj01(spark, sf):
    rows = table(spark, sf, "part").withColumn("k", F.col("p_partkey"))
    return R.melt(rows, ["k"], list(PART_COLUMNS))


@query(
    "prj02_column_catalogue",
    f"SELECT DISTINCT p_type AS sheet, position, raw_name, raw_name AS column_name "
    f"FROM ({sql_melt(PART_COLUMNS, 'part', 'p_type')})",
)
def prj02(spark, sf):
    rows = table(spark, sf, "part").withColumn("sheet", F.col("p_type"))
    return R.column_catalogue(R.melt(rows, ["sheet"], list(PART_COLUMNS)), ["sheet"])


LABELS = [
    ("l_quantity", "Quantity"),
    ("l_extendedprice", "Price"),
    ("l_discount", "Discount"),
    ("l_tax", "Tax"),
    ("l_missing", "Missing"),
]


@query(
    "prj03_unpivot_labels",
    " UNION ALL ".join(
        f"SELECT l_returnflag, '{code}' AS source_column_id, '{label}' AS label, count(*) AS n, "
        + (
            "0::BIGINT AS n_values, NULL::DOUBLE AS total "
            if code == "l_missing"
            else f"count({code}) AS n_values, CAST(sum(CAST({code} AS DECIMAL(18,2))) AS DOUBLE) AS total "
        )
        + "FROM lineitem GROUP BY l_returnflag"
        for code, label in LABELS
    ),
)
def prj03(spark, sf):
    long = R.unpivot_labels(table(spark, sf, "lineitem"), ["l_returnflag"], LABELS)
    return long.groupBy("l_returnflag", "source_column_id", "label").agg(
        F.count("*").alias("n"),
        F.count("value").alias("n_values"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(
    "prj04_tagged_union",
    """
    WITH u AS (
      SELECT 'annual' AS frequency, 1::BIGINT AS part_rank, CAST(year(o_orderdate) AS BIGINT) AS code, count(*) AS n FROM orders GROUP BY 3
      UNION ALL SELECT 'quarterly', 2, CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS BIGINT), count(*) FROM orders GROUP BY 3
      UNION ALL SELECT 'monthly', 3, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT), count(*) FROM orders GROUP BY 3)
    SELECT *, row_number() OVER (ORDER BY part_rank, code) AS row_no FROM u""",
)
def prj04(spark, sf):
    orders = table(spark, sf, "orders")
    year = F.year("o_orderdate")

    def rollup(code):
        return orders.groupBy(code.cast("bigint").alias("code")).agg(
            F.count("*").alias("n")
        )

    union = R.tagged_union(
        [
            ("annual", rollup(year)),
            ("quarterly", rollup(year * 10 + F.quarter("o_orderdate"))),
            ("monthly", rollup(year * 100 + F.month("o_orderdate"))),
        ]
    )
    return Q.number_rows(union, [], "code", "row_no", lead=["part_rank"])


@query(
    "prj05_carry_forward",
    """
    SELECT event_id, user_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS label_value FROM events""",
)
def prj05(spark, sf):
    label = F.when(F.col("event_type") == "signup", F.col("value"))
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value"
    )
    return Q.carry_forward(rows, ["user_id"], "event_id", label, "label_value").drop(
        "value"
    )


@query(
    "prj06_spanning_headers",
    """
    WITH h AS (SELECT p_brand, p_partkey, p_size % 5 AS span,
      coalesce(sum(p_size % 5) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM part)
    SELECT p_brand, p_partkey, CAST(before + unnest(range(1, span + 1)) AS BIGINT) AS column_position FROM h""",
)
def prj06(spark, sf):
    headers = table(spark, sf, "part").select(
        "p_brand", "p_partkey", (F.col("p_size") % 5).alias("span")
    )
    return R.expand_spans(headers, ["p_brand"], "p_partkey", "span").select(
        "p_brand", "p_partkey", "column_position"
    )


@query(
    "prj06_span_mismatch",
    """
    WITH h AS (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS span_total FROM orders),
    c AS (SELECT l_orderkey, count(*) AS column_count FROM lineitem GROUP BY 1)
    SELECT o_orderkey, span_total, column_count FROM h LEFT JOIN c ON o_orderkey = l_orderkey
    WHERE span_total <> coalesce(column_count, 0)""",
)
def prj06_mismatch(spark, sf):
    headers = table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("bigint").alias("span")
    )
    columns = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return R.span_mismatch(headers, columns, ["o_orderkey"], "span")


YEARS = list(range(1995, 2002))


@query(
    "prj07_year_columns",
    "SELECT c_mktsegment, o_orderpriority, "
    + ", ".join(
        f"CAST(sum(CASE WHEN year(o_orderdate) = {y} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS value_{y}"
        for y in YEARS
    )
    + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
)
def prj07(spark, sf):
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.expr("o_custkey = c_custkey")
    )
    keys = ["c_mktsegment", "o_orderpriority"]
    long = orders.groupBy(*keys, F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value")
    )
    return R.year_columns(long, keys, YEARS)


def spec_tables(spark, sf):
    """Regions as record sets, customers as rows, nations as measures."""
    condition = "struct<variable:string,value:string>"

    def conditions(*pairs):
        items = [
            F.struct(F.lit(name).alias("variable"), value.alias("value"))
            for name, value in pairs
        ]
        return F.array(*items).cast(f"array<{condition}>")

    nations = table(spark, sf, "nation")
    sets = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("set_id"),
        F.col("r_name").alias("id_prefix"),
        F.create_map(
            F.lit("nation"), F.lit("any"), F.lit("region"), F.col("r_name")
        ).alias("shared_filters"),
        conditions(("region", F.col("r_name"))).alias("shared_constraints"),
        F.concat(F.lit("G"), F.col("r_regionkey")).alias("set_geography_id"),
    )
    segment = F.col("c_mktsegment")
    rows = (
        table(spark, sf, "customer")
        .join(nations, F.expr("c_nationkey = n_nationkey"))
        .select(
            F.col("n_regionkey").alias("set_id"),
            F.col("c_name").alias("value_id"),
            F.col("c_custkey").alias("row_ordinal"),
            (F.col("c_custkey") + 2).alias("row_number"),
            F.when(segment == "BUILDING", F.col("c_custkey") + 4).alias(
                "row_end_number"
            ),
            F.when(segment == "MACHINERY", "Z").alias("row_column"),
            F.when(
                segment == "FURNITURE",
                F.create_map(F.lit("segment"), segment, F.lit("region"), F.lit("own")),
            )
            .otherwise(F.create_map(F.lit("segment"), segment))
            .alias("row_filters"),
            conditions(("segment", segment)).alias("row_constraints"),
            F.when(F.col("c_acctbal") > 5000, 1000).otherwise(1).alias("row_scale"),
            F.when(segment == "BUILDING", F.col("n_name")).alias("row_geography_id"),
            F.when(segment != "BUILDING", F.col("c_name")).alias("row_header"),
            segment.alias("row_label"),
        )
    )
    measures = nations.select(
        F.col("n_regionkey").alias("set_id"),
        F.col("n_name").alias("measure_id"),
        F.col("n_nationkey").cast("bigint").alias("measure_ordinal"),
        S.column_letters(F.col("n_nationkey") + 1).alias("measure_column"),
        F.create_map(F.lit("nation"), F.col("n_name")).alias("measure_filters"),
        conditions(("nation", F.col("n_name"))).alias("measure_constraints"),
        (F.col("n_nationkey") % 2 + 1).alias("measure_scale"),
    )
    return sets, rows, measures


SQL_SPECS = """
specs AS (SELECT r_regionkey AS set_id, c_custkey AS row_ordinal, CAST(m.n_nationkey AS BIGINT) AS measure_ordinal,
    r_name || '.' || c_name || '.' || m.n_name AS source_record_id,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Z' ELSE chr(65 + m.n_nationkey) END AS col,
    c_custkey + 2 AS row_number, CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey + 4 END AS row_end_number,
    'nation=' || m.n_name || ',region=' || CASE WHEN c_mktsegment = 'FURNITURE' THEN 'own' ELSE r_name END || ',segment=' || c_mktsegment AS filters,
    'region=' || r_name || ',segment=' || c_mktsegment || ',nation=' || m.n_name AS constraints,
    CAST((m.n_nationkey % 2 + 1) * CASE WHEN c_acctbal > 5000 THEN 1000 ELSE 1 END AS INTEGER) AS scale,
    CASE WHEN c_mktsegment = 'BUILDING' THEN cn.n_name ELSE 'G' || r_regionkey END AS geography_id,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE c_mktsegment END AS expected_row_header
  FROM customer JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region ON cn.n_regionkey = r_regionkey
    JOIN nation m ON m.n_regionkey = r_regionkey)"""


@query(
    "prj08_expand_spec",
    f"""
    WITH {SQL_SPECS} SELECT source_record_id, col || row_number AS address, col || row_end_number AS end_address,
      filters, constraints, scale, geography_id, expected_row_header FROM specs""",
)
def prj08(spark, sf):
    expanded = R.expand_spec(*spec_tables(spark, sf))
    pairs = F.transform(
        F.array_sort(F.map_entries("filters")),
        lambda item: F.concat_ws("=", item["key"], item["value"]),
    )
    conditions = F.transform(
        "constraints", lambda item: F.concat_ws("=", item["variable"], item["value"])
    )
    return expanded.select(
        "source_record_id",
        "address",
        F.when(F.col("row_end_number").isNotNull(), F.col("end_address")).alias(
            "end_address"
        ),
        F.array_join(pairs, ",").alias("filters"),
        F.array_join(conditions, ",").alias("constraints"),
        "scale",
        "geography_id",
        "expected_row_header",
    )


@query(
    "wn07_ordinal_expansion",
    f"""
    WITH {SQL_SPECS} SELECT set_id, source_record_id,
      row_number() OVER (PARTITION BY set_id ORDER BY row_ordinal, measure_ordinal) AS position FROM specs""",
)
def wn07(spark, sf):
    expanded = R.expand_spec(*spec_tables(spark, sf)).select(
        "set_id", "source_record_id", "row_ordinal", "measure_ordinal"
    )
    numbered = Q.number_rows(
        expanded, ["set_id"], "measure_ordinal", "position", lead=["row_ordinal"]
    )
    return numbered.drop("row_ordinal", "measure_ordinal")


@query(
    "ag09_spec_regions",
    f"""
    WITH {SQL_SPECS}, n AS (SELECT *, CAST(ascii(col) - 64 AS BIGINT) AS col_no FROM specs)
    SELECT set_id, min(row_number) AS top_row, least(1, min(col_no)) AS left_column,
      max(greatest(row_number, coalesce(row_end_number, row_number))) AS bottom_row, greatest(1, max(col_no)) AS right_column
    FROM n GROUP BY set_id""",
)
def ag09(spark, sf):
    expanded = R.expand_spec(*spec_tables(spark, sf))
    number = S.column_number(F.col("column"))
    return R.spec_regions(expanded, {"low": number, "high": number})


@query(
    "prj09_integer_range",
    """
    WITH p AS (SELECT DISTINCT p_size, p_type FROM part)
    SELECT p_size, p_type, concat_ws('|', (SELECT string_agg(CAST(i AS VARCHAR), '|' ORDER BY i) FROM range(0, p_size) t(i)),
      CASE WHEN p_type = 'PROMO' THEN p_size || ' and over' ELSE CAST(p_size AS VARCHAR) END, 'total', p_type) AS labels FROM p""",
)
def prj09(spark, sf):
    size = F.col("p_size")
    labels = R.integer_range(
        F.lit(0),
        size,
        F.when(F.col("p_type") == "PROMO", F.concat(size, F.lit(" and over"))),
        F.array(F.lit("total"), F.col("p_type")),
    )
    return (
        table(spark, sf, "part")
        .select("p_size", "p_type")
        .distinct()
        .withColumn("labels", F.array_join(labels, "|"))
    )


GRID = {"c_custkey": "integer", "c_name": "string", "c_acctbal": "number"}
_GRID_ROW = sql_digest(
    "row.v1",
    sql_record({"artifact": "artifact", "sheet": "'rows'", "row": "c_custkey"}),
)


@query(
    "prj10_row_grid",
    f"""
    WITH n AS (SELECT *, sha256('customer') AS artifact, 1 + row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS grid_row FROM customer),
    b AS ({sql_melt(GRID, 'n', 'c_mktsegment, grid_row, c_custkey AS line, artifact')}),
    h AS (SELECT DISTINCT c_mktsegment, 1::BIGINT AS grid_row, position, raw_name FROM b)
    SELECT c_mktsegment, grid_row, position AS grid_column, kind, value_text AS raw, value_num, 'source_line_number=' || line AS note,
      chr(CAST(64 + position AS INTEGER)) || grid_row AS address, {_GRID_ROW.replace('c_custkey', 'line')} AS source_row_key FROM b
    UNION ALL SELECT c_mktsegment, grid_row, position, 'text', raw_name, NULL, NULL, chr(CAST(64 + position AS INTEGER)) || grid_row, NULL FROM h""",
)
def prj10(spark, sf):
    rows = table(spark, sf, "customer").withColumn(
        "artifact", F.sha2(F.lit("customer"), 256)
    )
    return R.row_grid(rows, ["c_mktsegment"], "c_custkey", list(GRID), "artifact")


@query(
    "prj11_render_templates",
    """
    WITH t AS (SELECT DISTINCT year(o_orderdate) AS y, o_orderstatus AS st FROM orders),
    r AS (SELECT y, st, CASE st WHEN 'F' THEN CAST(y AS VARCHAR) WHEN 'O' THEN '0' || y ELSE 'Filed ' || (y + 1) || ' for ' || y END AS rendered FROM t)
    SELECT y, st, rendered, CASE WHEN st = 'F' THEN CAST(y AS BIGINT) END AS number FROM r""",
)
def prj11(spark, sf):
    status = F.col("st")
    template = (
        F.when(status == "F", "{year}")
        .when(status == "O", "0{year}")
        .otherwise("Filed {filing_year} for {year}")
    )
    return (
        table(spark, sf, "orders")
        .select(F.year("o_orderdate").cast("bigint").alias("y"), F.col("o_orderstatus").alias("st"))
        .distinct()
        .withColumn("rendered", S.render_template(template, F.col("y")))
        .withColumn("number", S.rendered_number(F.col("rendered")))
    )


@query(
    "prj14_drop_empty",
    """
    SELECT event_id, CASE WHEN event_type = 'view' THEN value END AS a, props AS c
    FROM events WHERE event_type <> 'error'""",
)
def prj14(spark, sf):
    kind = F.col("event_type")
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "view", F.col("value")).alias("a"),
        F.lit(None).cast("string").alias("b"),
        F.when(kind != "error", F.col("props")).alias("c"),
    )
    return R.drop_empty(rows, ["a", "b", "c"])


@query(
    "prj15_json_entries",
    """
    SELECT event_id, unnest(json_keys(props)) AS key, json_extract_string(props, '$.k') AS value FROM events
    UNION ALL SELECT event_id, 'nested', '{"type":"' || event_type || '"}' FROM events""",
)
def prj15(spark, sf):
    wider = F.concat(
        F.regexp_replace("props", r"\}$", ""),
        F.lit(',"nested":{"type":"'),
        F.col("event_type"),
        F.lit('"}}'),
    )
    rows = table(spark, sf, "events").select("event_id", wider.alias("props"))
    return R.json_entries(rows, ["event_id"], "props")


@query(
    "wn02_ordinals",
    """
    WITH n AS (SELECT o_orderstatus, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS row_no FROM orders),
    c AS (SELECT *, string_split(o_orderpriority, '-') AS words FROM n)
    SELECT o_orderstatus, o_orderkey, row_no, CAST(unnest(range(0, len(words))) AS INTEGER) AS ordinal, unnest(words) AS word FROM c""",
)
def wn02(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderkey", "o_orderpriority"
    )
    return Q.number_rows(rows, ["o_orderstatus"], "o_orderkey", "row_no").select(
        "o_orderstatus",
        "o_orderkey",
        "row_no",
        F.posexplode(F.split("o_orderpriority", "-")).alias("ordinal", "word"),
    )
