"""Evidence rules on hand-made rows; key properties on the shared facts."""

import pytest
from pyspark.sql import functions as F

from conftest import FOLDER
from factloom.functions import keys as K
from factloom.operators import selectors as L
from factloom.plans import evidence as E
from factloom.plans import facts as P
from factloom.suite.fact_base import flat_facts, order_facts


def one_fact(spark, filters, constraints, row_keys, cell_keys=(), period="2021"):
    rows = [(1, period, filters, constraints, list(row_keys), list(cell_keys))]
    frame = spark.createDataFrame(
        rows,
        f"seq long, period_value string, filters map<string,string>, "
        f"constraints array<{P.CONSTRAINT}>, source_row_keys array<string>, "
        "source_cell_keys array<string>",
    )
    return P.nest_facts(frame).withColumns(
        {"domain": F.lit("d"), "assertion": F.lit("observation")}
    )


def term(variable, operator, value):
    return (variable, operator, value, None, None, None)


def row_values(spark, rows):
    data = [
        (key, i, name, value)
        for key, values in rows.items()
        for i, (name, value) in enumerate(values, 1)
    ]
    return spark.createDataFrame(
        data, "row_key string, position int, raw_name string, value_text string"
    )


def cells(spark, *rows):
    return spark.createDataFrame(
        list(rows) or [("none", None, None)], "cell_key string, raw string, display string"
    )


def codes(spark, fact, rows, *coded):
    found = E.evidence_issues(fact, "seq", row_values(spark, rows), cells(spark, *coded))
    return sorted((r["variable"], r["code"], r["mismatches"]) for r in found.collect())


def test_age_bands_of_all_rows_must_join(spark):
    rows = {"r1": [("AGE NAME", "Aged 5-9")], "r2": [("AGE NAME", "Aged 10-14")]}
    good = one_fact(spark, {}, [term("person.age", ">=", "5"), term("age", "<", "15")], rows)
    assert codes(spark, good, rows) == []
    gap = {**rows, "r3": [("AGE NAME", "Aged 16-17")]}
    bad = one_fact(spark, {}, [term("age", ">=", "5")], gap)
    # No column is called "age" alone, so nothing else backs the constraint.
    assert codes(spark, bad, gap) == [("age", "row_constraint_not_evidenced", 0)]


def test_header_codes_need_any_match(spark):
    rows = {"r": [("x", "1")]}
    variable = "us.tax.eitc_qualifying_children"
    fact = one_fact(spark, {"eitc_child_count": "3plus"}, [term(variable, ">=", "3")], rows, ["c1", "c2"])
    coded = [("c1", "N59661", None), ("c2", None, " n59664 ")]
    assert codes(spark, fact, rows, *coded) == []
    assert codes(spark, fact, rows, coded[0]) == [
        ("eitc_child_count", "row_filter_not_evidenced", 0),
        (variable, "row_constraint_not_evidenced", 0),
    ]


def test_age_header_codes(spark):
    rows = {"r": [("x", "1")]}
    fact = one_fact(spark, {}, [term("age", ">=", "84"), term("age", "<", "86")], rows, ["c1", "c2"])
    coded = [("c1", "POP_84", None), ("c2", "POP_85", None)]
    assert codes(spark, fact, rows, *coded) == [("age", "row_constraint_not_evidenced", 0)]


def test_bound_columns_and_period(spark):
    rows = {
        "r1": [("period", "2021"), ("AGI lower bound", "1,000")],
        "r2": [("period", "2020"), ("AGI lower bound", "1000.0")],
    }
    fact = one_fact(spark, {}, [term("irs.agi", ">=", "1000")], rows)
    assert codes(spark, fact, rows) == [
        ("period", "fact_period_not_evidenced_by_source_row", 1)
    ]


def test_income_codes_bound_the_whole_lineage(spark):
    rows = {"r1": [("agi_stub", "3")], "r2": [("agi_stub", "4")]}
    terms = [term("agi", ">=", "10000"), term("agi", "<", "50000")]
    fact = one_fact(spark, {"income_range": "10k_to_50k"}, terms, rows)
    assert codes(spark, fact, rows) == []
    wrong = one_fact(spark, {"income_range": "10k_to_25k"}, terms[:1], rows)
    assert codes(spark, wrong, rows) == [("income_range", "row_filter_value_mismatch", 1)]


def test_last_column_of_a_repeated_name_wins(spark):
    rows = {"r": [("Region", "A"), ("region ", "B")]}
    fact = one_fact(spark, {"region": "B"}, [], rows)
    assert codes(spark, fact, rows) == []


def test_equal_facts_are_judged_once(spark):
    """500 facts of two sorts; the rows differ in a column that no claim asks for."""
    numbers = spark.range(500)
    key = F.concat(F.lit("r"), "id")
    other = F.col("id") % 5 == 0
    flat = numbers.select(
        F.col("id").alias("seq"),
        F.lit("2021").alias("period_value"),
        F.create_map(F.lit("region"), F.lit("A")).alias("filters"),
        F.array().cast(f"array<{P.CONSTRAINT}>").alias("constraints"),
        F.array(key, F.lit("gone")).alias("source_row_keys"),
        F.array().cast("array<string>").alias("source_cell_keys"),
    )
    facts = P.nest_facts(flat)
    region = F.when(other, "B").otherwise("A")
    item = lambda at, name, value: F.struct(F.lit(at).alias("position"), F.lit(name).alias("raw_name"), value.cast("string").alias("value_text"))
    values = numbers.select(
        key.alias("row_key"), F.inline(F.array(item(1, "Region", region), item(2, "Amount", F.col("id"))))
    )
    backed = E._backed(facts, "seq")
    words = E.lexicon(spark.createDataFrame([("region",), ("period",)], "variable string"))
    sorts = E.sorted_facts(backed, "seq", values, E.asked_names(words), E._coded_cells(cells(spark)))
    assert sorts.count() == 500
    assert sorts.select(*E.SORT).distinct().count() == 2
    found = E.evidence_issues(facts, "seq", values, cells(spark)).collect()
    # The filter stands for a constraint as well.
    expected = [(i, f"row_{kind}_value_mismatch", 1) for i in range(0, 500, 5) for kind in ("constraint", "filter")]
    assert sorted((r["seq"], r["code"], r["mismatches"]) for r in found) == expected


def test_label_and_layout_do_not_change_keys(spark):
    facts = order_facts(spark, FOLDER)
    keyed = K.with_fact_keys(facts)
    other = K.with_fact_keys(
        facts.withColumn("label", F.lit("x"))
        .withColumn("layout", F.col("layout").withField("source_row_id", F.lit("y")))
        .repartition(5)
    )
    names = ["seq", "legacy_fact_key", "aggregate_fact_key", "semantic_fact_key"]
    assert keyed.select(*names).exceptAll(other.select(*names)).count() == 0


def test_constraint_order_and_label_only_matter_in_the_first_generation(spark):
    a, b = term("a", "==", "1"), term("b", "<", "2")
    first = one_fact(spark, {}, [a, b], ["r"])
    second = one_fact(spark, {}, [b, (*a[:5], "label")], ["r"])
    key = lambda frame, make: frame.select(make().alias("k")).first()["k"]
    assert key(first, K.fact_key) != key(second, K.fact_key)
    assert key(first, K.constraint_set_key) == key(second, K.constraint_set_key)


def test_flatten_is_the_inverse_of_nest(spark):
    flat = flat_facts(spark, FOLDER)
    back = P.flatten_facts(P.nest_facts(flat))
    names = ["seq", "period_int", "geography_id", "concept", "record_set_id", "raw_uri"]
    assert back.select(*names).exceptAll(flat.select(*names)).count() == 0


@pytest.mark.parametrize(
    ("expected", "issue"),
    [
        (("integer", "5", 5.0), None),
        (("number", "5.0", 5.0), None),
        (("string", "5", None), "guard_mismatch"),
        (("boolean", "true", None), "guard_mismatch"),
        (("integer", "6", 6.0), "guard_mismatch"),
    ],
)
def test_guard_types(spark, expected, issue):
    guards = spark.createDataFrame(
        [(1, "g", "B2", *expected)],
        "record_id int, guard string, address string, expected_type string, "
        "expected_text string, expected_num double",
    )
    sheet = spark.createDataFrame(
        [("B2", "integer", "5", 5.0)],
        "address string, value_type string, value_text string, value_num double",
    )
    assert L.check_guards(guards, sheet, ["address"]).first()["issue"] == issue


def test_range_labels_need_one_label_per_row(spark):
    text = lambda v: (None if v is None else "string", v, None)
    rows = [
        (1, 2, 4, ["a", "b", "c"]),
        (2, 2, 4, ["a", "x", "c"]),
        (3, 2, 4, ["a", "b"]),
        (4, 2, 3, ["a", None]),
        (5, 2, None, ["a"]),
        (6, 4, 5, ["c", "d"]),
        (7, 2, 2, None),
    ]
    labels = spark.createDataFrame(
        [(i, "g", 1, a, b, e and [text(v) for v in e]) for i, a, b, e in rows],
        "record_id int, guard string, column long, row_from long, row_to long, "
        "expected array<struct<type: string, text: string, num: double>>",
    )
    cells_ = spark.createDataFrame(
        [(r, 1, "string", t, None) for r, t in ((2, "a"), (3, "b"), (4, "c"))],
        "row long, column long, value_type string, value_text string, value_num double",
    )
    found = {}
    for r in L.check_range_labels(labels, cells_).collect():
        found.setdefault(r["record_id"], {})[r["row"]] = r["issue"]
    assert found == {
        1: {2: None, 3: None, 4: None},
        2: {2: None, 3: "guard_mismatch", 4: None},
        3: {None: "label_count"},
        4: {None: "null_label"},
        5: {None: "no_end_address"},
        6: {4: None, 5: "missing_guard_cell"},
        7: {None: "label_count"},
    }


def test_regions_across_blocks_give_each_pair_once(spark):
    cells_ = spark.createDataFrame([(r, 1) for r in range(1, 200)], "r long, c long")
    regions = spark.createDataFrame(
        [("a", 5, 150, 1, 1), ("b", 64, 64, 1, 2), ("c", 9, 3, 1, 1)],
        "region_id string, top_row long, bottom_row long, left_column long, right_column long",
    )
    pairs = L.covering_regions(cells_, regions, F.col("r"), F.col("c"), block=16)
    counts = {r["region_id"]: r["n"] for r in pairs.groupBy("region_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 146, "b": 1}
