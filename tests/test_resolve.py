"""The period rule on hand-made facts."""

import pytest
from pyspark.sql import functions as F

from factloom.plans import resolve as PR

FACTS = [
    ("tax_year", "2021", 2021, "s", 100),
    ("tax_year", "2022", 2022, "s", 110),
    ("calendar_year", "2027", 2027, "p", 250),
    ("tax_year", "2021", 2021, "m", 1),
    ("month", "2021-05", None, "m", 2),
    ("month", "2021-05", None, "t", 3),
    ("month", "2020-12", None, "t", 4),
    ("month", "9", None, "t", 5),
]


def facts(spark):
    frame = spark.createDataFrame(
        FACTS,
        "period_type string, period_value string, period_int long, "
        "source_name string, value long",
    )
    return frame.withColumns(
        {"geography_level": F.lit("country"), "assertion": F.lit("observation")}
    )


def targets(spark, **selectors):
    rows = [(name, selector, ["country"]) for name, selector in selectors.items()]
    return spark.createDataFrame(
        rows, "target_id string, selector map<string,string>, geography_levels array<string>"
    )


def alignments(spark, *rows):
    return spark.createDataFrame(list(rows), "target_id string, alignment string")


def states(spark, asked, kind, value, *aligned):
    match = PR.matcher(asked, facts(spark), "country")
    state = PR.outcomes(asked, match, kind, value, alignments(spark, *aligned), "country")
    return {r["target_id"]: r for r in state.collect()}


def test_exact_period_wins(spark):
    asked = targets(spark, a={"source_name": "s"})
    row = states(spark, asked, "tax_year", "2021")["a"]
    assert (row["outcome"], row["basis"], row["period_value"]) == ("resolved", "fact", "2021")


def test_newest_not_after_needs_alignment(spark):
    asked = targets(spark, a={"source_name": "s"})
    row = states(spark, asked, "tax_year", "2025")["a"]
    assert (row["outcome"], row["period_value"]) == ("violation", "2022")
    row = states(spark, asked, "tax_year", "2025", ("a", "aged"))["a"]
    assert (row["basis"], row["alignment"]) == ("declared_alignment", "aged")


def test_only_later_periods_of_one_type(spark):
    asked = targets(spark, a={"source_name": "p"})
    row = states(spark, asked, "tax_year", "2024")["a"]
    assert (row["outcome"], row["period_type"], row["period_value"]) == (
        "violation",
        "calendar_year",
        "2027",
    )


def test_two_types_without_match_are_ambiguous(spark):
    asked = targets(spark, a={"source_name": "m"})
    assert states(spark, asked, "fiscal_year", "2021")["a"]["outcome"] == (
        "ambiguous_period_type"
    )


def test_text_periods_compare_as_text(spark):
    asked = targets(spark, a={"source_name": "t"})
    row = states(spark, asked, "month", "2021-01", ("*", "carried"))["a"]
    assert (row["period_value"], row["alignment"]) == ("2020-12", "carried")
    late = states(spark, asked, "month", "2019-01", ("*", "carried"))["a"]
    assert late["period_value"] == "9"


def test_wildcard_gives_no_warning(spark):
    asked = targets(spark, a={"source_name": "s"}, b={"source_name": "s"})
    found = states(spark, asked, "tax_year", "2022", ("*", "w"), ("b", "own"))
    assert (found["a"]["warning"], found["b"]["warning"]) == (None, "unused_alignment")


def test_selector_problems(spark):
    asked = targets(
        spark, a={"colour": "red"}, b={"source_name": "zz"}, c={}, d={"domain": "x"}
    )
    frame = facts(spark).withColumn("domain", F.lit(None).cast("string"))
    match = PR.matcher(asked, frame, "country")
    state = PR.outcomes(
        asked, match, "tax_year", "2022", alignments(spark, ("*", "w")), "country"
    )
    found = {r["target_id"]: r["outcome"] for r in state.collect()}
    assert found == {
        "a": "unknown_selector_key",
        "b": "no_matching_facts",
        "c": "resolved",
        "d": "no_matching_facts",
    }


def test_strict_raises_and_lenient_reports(spark):
    asked = targets(spark, a={"source_name": "s"})
    none = alignments(spark, ("x", "y"))
    with pytest.raises(ValueError, match="violation"):
        PR.resolve(asked, facts(spark), "tax_year", "2030", none, strict=True)
    report = PR.resolve(asked, facts(spark), "tax_year", "2022", none, strict=True)
    assert [r["value"] for r in report.resolved.collect()] == [110]
    assert report.violations.count() == 0


def test_materialised_facts_equal_the_lazy_ones(spark):
    from factloom.session import checkpoint_dir, materialise

    plain = facts(spark)
    copy = materialise(plain, "test-facts")
    assert sorted(copy.collect()) == sorted(plain.collect())
    if checkpoint_dir(spark) is not None:
        assert all("test-facts" in name for name in copy.inputFiles())


def test_a_null_selector_value_meets_only_facts_without_it(spark):
    targets = spark.createDataFrame(
        [(1, {"source_name": None}), (2, {})], "target_id int, selector map<string,string>"
    )
    facts = spark.createDataFrame([("a",), (None,)], "source_name string")
    keys = {r["target_id"]: r["k"] for r in targets.select("target_id", PR.selector_key().alias("k")).collect()}
    found = facts.select("source_name", PR.fact_selector_key(["source_name"]).alias("k")).collect()
    by = {r["source_name"]: r["k"] for r in found}
    assert by[None] == keys[1] and by["a"] != keys[1] and keys[2] == ""
    assert len({*PR.signatures(targets)}) == 2


def test_many_asked_sets_equal_brute_force(spark):
    """Any sets of keys at once; tuples, not facts, are expanded to them."""
    import itertools
    import random

    rng = random.Random(8)
    names = ["assertion", "concept", "domain", "entity", "source_name", "source_table"]
    pick = lambda: rng.choice(["a", "b", "a|b", "x=1", None])
    facts = []
    for _ in range(400):
        kind, value = rng.choice([("calendar_year", 1990 + rng.randint(0, 3)), ("month", None)])
        facts.append((*[pick() for _ in names], "state", kind, str(value), value))
    facts = facts * 3 + [(*["a"] * 6, "country", "calendar_year", "1990", 1990)]
    targets = []
    for n in range(len(names) + 1):
        for keys in itertools.combinations(names, n):
            targets.append((f"t{len(targets)}", {k: pick() for k in keys}, ["state"]))
    fact_columns = ", ".join(f"{n} string" for n in names)
    frame = spark.createDataFrame(
        facts, f"{fact_columns}, geography_level string, period_type string, period_value string, period_int long"
    )
    asked = spark.createDataFrame(
        targets, "target_id string, selector map<string,string>, geography_levels array<string>"
    )
    match = PR.matcher(asked, frame, "state")
    found = {
        (r["target_id"], r["period_type"], r["period_value"], r["assertion"]): r["fact_count"]
        for r in match.combinations().collect()
    }
    expected = {}
    for target, selector, _ in targets:
        for fact in facts:
            held = dict(zip(names, fact))
            if fact[6] == "state" and all(held[k] == v for k, v in selector.items()):
                key = (target, fact[7], fact[8], held["assertion"])
                expected[key] = expected.get(key, 0) + 1
    assert found == expected
    assert match.links.count() <= match.counted.select("tuple_key").distinct().count() * len(targets)
    chosen = asked.select("target_id", F.lit("calendar_year").alias("period_type"), F.lit("1991").alias("period_value"))
    rows = match.facts_at(chosen).groupBy("target_id").count().collect()
    wanted = {}
    for (target, kind, value, _), n in expected.items():
        if (kind, value) == ("calendar_year", "1991"):
            wanted[target] = wanted.get(target, 0) + n
    assert {r["target_id"]: r["count"] for r in rows} == wanted


def test_repeated_alignments_are_issues(spark):
    facts = spark.createDataFrame(
        [("s", "state", "calendar_year", "1990", 1990, "observation")],
        "source_name string, geography_level string, period_type string, period_value string, period_int long, assertion string",
    )
    targets = spark.createDataFrame(
        [("t", {"source_name": "s"}, ["state"])],
        "target_id string, selector map<string,string>, geography_levels array<string>",
    )
    for entries, outcome in (([("*", "a"), ("*", "b")], "violation"), ([("*", "a")], "resolved")):
        given = spark.createDataFrame(entries, "target_id string, alignment string")
        report = PR.resolve(targets, facts, "calendar_year", "1995", given, "state")
        assert (report.violations.count() == 1) == (outcome == "violation")
        codes = [(r["target_id"], r["code"], r["severity"]) for r in report.issues.collect()]
        assert codes == ([("*", "repeated_alignment", "error")] if len(entries) > 1 else [])
