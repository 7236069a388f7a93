"""Queries for the content keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import canonical as C
from factloom.functions import keys as K
from factloom.suite.fact_base import SQL_FACTS, SQL_KEYED, order_facts
from factloom.suite.registry import query, sql_digest, sql_record, table

WITH_KEYS = f"WITH {SQL_FACTS}, {SQL_KEYED}"


def keyed_facts(spark, sf):
    return K.with_fact_keys(order_facts(spark, sf))


def pick(names):
    def run(spark, sf):
        return keyed_facts(spark, sf).select("seq", *names)

    return run


for _name, _columns in {
    "key01_fact_key": ("legacy_fact_key",),
    "key03_release_series_keys": ("source_release_key", "source_series_key"),
    "key04_component_keys": (
        "observed_measure_key",
        "dimension_set_key",
        "universe_constraint_set_key",
    ),
    "key05_aggregate_semantic_keys": ("aggregate_fact_key", "semantic_fact_key"),
    "key06_alignment_key": ("concept_alignment_key",),
}.items():
    query(_name, f"{WITH_KEYS} SELECT seq, {', '.join(_columns)} FROM keyed")(
        pick(_columns)
    )

_ROW = sql_digest(
    "row.v1",
    sql_record({"artifact": "sha256(p_brand)", "sheet": "p_type", "row": "p_partkey"}),
)
_COLUMN = sql_digest(
    "column.v1",
    sql_record(
        {
            "artifact": "sha256(p_brand)",
            "sheet": "p_type",
            "position": "2",
            "name": "'p_name'",
        }
    ),
)


@query(
    "key02_coordinate_keys",
    f"""
    WITH k AS (SELECT p_partkey, {_ROW} AS row_key, {_COLUMN} AS column_key,
      {sql_digest("cell.v1", sql_record({"artifact": "sha256(p_brand)", "sheet": "p_type", "row": "p_partkey", "column": "2"}))} AS cell_key
      FROM part)
    SELECT *, {sql_digest("row_value.v1", sql_record({"row": "row_key", "column": "column_key"}))} AS value_key FROM k""",
)
def key02(spark, sf):
    sha, sheet = F.sha2("p_brand", 256), F.col("p_type")
    row, two = F.col("p_partkey"), F.lit(2)
    return (
        table(spark, sf, "part")
        .select(
            "p_partkey",
            K.row_key(sha, sheet, row).alias("row_key"),
            K.column_key(sha, sheet, two, F.lit("p_name")).alias("column_key"),
            K.cell_key(sha, sheet, row, two).alias("cell_key"),
        )
        .withColumn(
            "value_key", K.row_value_key(F.col("row_key"), F.col("column_key"))
        )
    )


@query(
    "key07_stratum_hash",
    r"""
    WITH s AS (SELECT DISTINCT r_name, n_name, c_mktsegment FROM customer
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    t AS (SELECT *, 'variable=nation|operator===|value=' || n_name AS a,
      'variable=Segment|operator===|value=' || c_mktsegment AS b FROM s)
    SELECT r_name, n_name, c_mktsegment, substr(sha256('jurisdiction=' || r_name || '|constraints=' ||
      replace(replace(replace(b, '|', '\|') || '|' || replace(a, '|', '\|'), '\', '\\'), '|', '\|')), 1, 16) AS stratum FROM t""",
)
def key07(spark, sf):
    places = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("r_name", "n_name", "c_mktsegment")
        .distinct()
    )

    def item(name, value):
        return F.struct(
            F.lit(name).alias("variable"),
            F.lit("==").alias("operator"),
            F.col(value).alias("value"),
        )

    constraints = F.array(item("nation", "n_name"), item("Segment", "c_mktsegment"))
    return places.withColumn("stratum", K.stratum_hash(constraints, F.col("r_name")))


@query(
    "key08_spec_hash",
    r"""
    WITH s AS (SELECT p_partkey, concat_ws('|', 'value_id=' || p_name, 'ordinal=' || CAST(p_partkey AS VARCHAR),
      CASE WHEN p_size <> 1 THEN 'value_scale=' || CAST(p_size AS VARCHAR) END,
      CASE WHEN p_type <> 'ECONOMY' THEN 'guards=' || replace(least(p_brand, p_type) || '|' || greatest(p_brand, p_type), '|', '\|') END) AS text
      FROM part)
    SELECT p_partkey, substr(sha256(text), 1, 24) AS spec_hash FROM s""",
)
def key08(spark, sf):
    guards = F.when(
        F.col("p_type") != "ECONOMY", F.array("p_brand", "p_type")
    ).otherwise(F.array().cast("array<string>"))
    fields = {
        "value_id": F.col("p_name"),
        "ordinal": F.col("p_partkey"),
        "value_scale": F.col("p_size"),
    }
    return table(spark, sf, "part").select(
        "p_partkey", K.spec_hash(fields, {"value_scale": 1}, guards).alias("spec_hash")
    )


ORDER_FIELDS = ("o_custkey", "o_orderstatus", "o_orderpriority")
_LEVELS = """
    a AS (SELECT o_orderstatus, h, count(*) AS n FROM t GROUP BY 1, 2),
    b AS (SELECT o_orderstatus, substr(h, 1, 6) AS p, sha256(string_agg(h || ':' || n, ',' ORDER BY h || ':' || n)) AS x, sum(n) AS n FROM a GROUP BY 1, 2),
    c AS (SELECT o_orderstatus, substr(p, 1, 3) AS p, sha256(string_agg(x, ',' ORDER BY x)) AS x, sum(n) AS n FROM b GROUP BY 1, 2),
    d AS (SELECT o_orderstatus, sha256(string_agg(x, ',' ORDER BY x)) AS x, sum(n) AS n FROM c GROUP BY 1)
    SELECT o_orderstatus, 'build.v1:' || substr(x, 1, 24) AS digest, CAST(n AS BIGINT) AS row_count FROM d"""


@query(
    "key09_dataset_digest",
    f"""
    WITH t AS (SELECT o_orderstatus, sha256({sql_record({n: n for n in ORDER_FIELDS})}) AS h FROM orders), {_LEVELS}""",
)
def key09(spark, sf):
    text = C.record({name: F.col(name) for name in ORDER_FIELDS})
    return K.dataset_digest(table(spark, sf, "orders"), text, ["o_orderstatus"])


@query(
    "key10_artifact_key",
    f"""
    SELECT p_partkey, {sql_digest("build_artifact.v1", sql_record({"artifact_name": "p_name", "build_id": "p_brand", "sha256": "sha256(p_type)"}), 32)} AS key FROM part""",
)
def key10(spark, sf):
    key = K.artifact_key(F.col("p_brand"), F.col("p_name"), F.sha2("p_type", 256))
    return table(spark, sf, "part").select("p_partkey", key.alias("key"))


@query(
    "key11_forged_keys",
    f"""
    {WITH_KEYS} SELECT seq, semantic_fact_key AS aggregate_fact_key, aggregate_fact_key AS recomputed_key
    FROM keyed WHERE pr = '1' AND st = 'F'""",
)
def key11(spark, sf):
    forged = (F.col("entity.name") == "household") & F.col("geography.vintage").isNull()
    stated = F.when(forged, F.col("semantic_fact_key")).otherwise(
        F.col("aggregate_fact_key")
    )
    rows = keyed_facts(spark, sf).withColumn("aggregate_fact_key", stated)
    return K.forged_keys(rows).select("seq", "aggregate_fact_key", "recomputed_key")
