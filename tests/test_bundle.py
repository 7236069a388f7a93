"""A bundle isolates the packages that break the contract."""

from pyspark.sql import functions as F

from conftest import FOLDER
from factloom.plans import bundle as B
from factloom.plans import facts as P
from factloom.plans import schema as PS
from factloom.suite.fact_base import order_facts

SCHEMA = {
    "required": ["aggregate_fact_key"],
    "properties": {"source": {"properties": {"source_name": {"type": "string"}}}},
}


def test_failed_packages_are_issues_and_others_go_on(spark):
    row = lambda a, s, name='"n"': f'{{"aggregate_fact_key":"{a}","semantic_fact_key":"{s}","source":{{"source_name":{name}}}}}'
    lines = [("good", row("a", "s")), ("good", row("b", "s")), ("more", row("a", "t")), (None, row("c", "u"))]
    lines += [("bad", row("d", "v")), ("bad", row("e", "w", "1")), ("bad", "{}"), ("worse", "{")]
    frame = spark.createDataFrame(lines, "package string, text string")
    asked = spark.createDataFrame([("good",), ("absent",)], "package string")
    found = B.build_bundle(frame, asked, SCHEMA)
    assert sorted(r["aggregate_fact_key"] for r in found.rows.collect()) == ["a", "a", "b", "c"]
    states = {r["package"]: (r["row_count"], r["invalid_rows"], r["state"]) for r in found.packages.collect()}
    assert states == {"good": (2, 0, "built"), "more": (1, 0, "built"), None: (1, 0, "built"), "bad": (3, 2, "failed"), "worse": (1, 1, "failed")}
    issues = {(r["code"], r["severity"], r["package"], r["key"], r["detail"], r["n"]) for r in found.issues.collect()}
    assert issues == {
        ("package_build_failed", "error", "bad", None, "<root>: required", 2),
        ("package_build_failed", "error", "worse", None, "<root>: not_json", 1),
        ("package_without_rows", "error", "absent", None, None, None),
        ("duplicate_aggregate_fact_key", "error", None, "a", None, 2),
        ("duplicate_semantic_fact_key", "warning", None, None, None, 1),
    }
    empty = B.build_bundle(frame.limit(0), None, SCHEMA)
    assert all(part.count() == 0 for part in empty)


def test_consumer_rows_hold_the_contract(spark):
    rows = P.consumer_rows(order_facts(spark, FOLDER)).limit(300)
    lines = rows.select("aggregate_fact_key", B.contract_json(rows).alias("text"))
    assert PS.validate_rows(lines, ["aggregate_fact_key"], "text", PS.contract_row_schema()).count() == 0
    one = lines.select(F.get_json_object("text", "$.value").alias("v")).first()["v"]
    assert float(one) > 0


def test_counts_are_of_columns_read_with_the_check(spark):
    """Rows are read once, before they are stored; their texts are not read again for each dimension."""
    row = '{"aggregate_fact_key":"%s","semantic_fact_key":"s","source":{"source_name":"n\\"1","x":[1]},"period":{"value":%s},"geography":{},"assertion":"a"}'
    lines = [("p", row % ("a", "1997")), ("p", row % ("b", '"1997"')), ("p", row % ("c", "null")), ("q", row % ("d", "1.50"))]
    found = B.build_bundle(spark.createDataFrame(lines, "package string, text string"), None, SCHEMA)
    assert {(r["dim"], r["key"]): r["n"] for r in found.counts.collect()} == {
        ("source", 'n"1'): 4, ("period", "1997"): 2, ("period", "1.5"): 1, ("assertion", "a"): 4,
    }
    assert "get_json_object" not in found.counts._jdf.queryExecution().executedPlan().toString()
