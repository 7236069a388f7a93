"""Compiled schemas on hand-made rows."""

import json

import pytest

from factloom.plans import schema as PS


def found(spark, schema, *rows):
    frame = spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)], "i int, text string")
    out = {}
    for r in PS.validate_rows(frame, ["i"], "text", schema).collect():
        out.setdefault(r["i"], []).append((r["location"], r["rule"]))
    return [sorted(out.get(i, [])) for i in range(len(rows))]


def test_types_and_bounds(spark):
    schema = {
        "properties": {
            "n": {"type": "integer", "minimum": 1, "exclusiveMaximum": 5},
            "s": {"type": ["string", "null"], "minLength": 2, "maxLength": 3, "pattern": "^a"},
            "b": {"type": "boolean"},
            "x": {"type": "number"},
        }
    }
    rows = [{"n": 1}, {"n": 1.0}, {"n": 1.5}, {"n": 0}, {"n": 5}, {"n": True}, {"s": None}, {"s": "é"}, {"s": "abcd"}, {"b": 1}, {"x": "1"}, [], 3]
    assert found(spark, schema, *rows) == [
        [], [], [("n", "type")], [("n", "minimum")], [("n", "exclusiveMaximum")], [("n", "type")], [],
        [("s", "minLength"), ("s", "pattern")], [("s", "maxLength")], [("b", "type")], [("x", "type")], [], [],
    ]


def test_depth_references_and_conditions(spark):
    schema = {
        "type": "object",
        "$defs": {"leaf": {"type": "object", "required": ["k"], "additionalProperties": {"enum": [1, "a", None, [1]]}}},
        "properties": {"list": {"type": "array", "minItems": 1, "items": {"type": "array", "items": {"$ref": "#/$defs/leaf"}}}},
        "anyOf": [{"required": ["list"]}, {"required": ["other"]}],
        "if": {"required": ["other"]},
        "then": {"properties": {"other": {"const": {"q": 1}}}},
        "else": {"not": {"required": ["bad/name"]}},
        "oneOf": [{"required": ["list"]}, {"properties": {"list": False}}],
        "maxProperties": 3,
    }
    rows = [
        {"list": [[{"k": 1}]]}, {"list": []}, {"list": [[{"k": 2}], [{}, {"k": None, "z": [1], "y": [2]}]]},
        {"other": {"q": 1}}, {"other": {"q": 2}}, {}, {"list": [[]], "bad/name": 1}, "{", "null", {"list": [[]], "a": 1, "b": 1, "c": 1},
    ]
    assert found(spark, schema, *rows) == [
        [], [("list", "minItems")],
        [("list/0/0/k", "enum"), ("list/1/0", "required"), ("list/1/1/y", "enum")],
        [], [("other", "const")], [("<root>", "anyOf")], [("<root>", "not")], [("<root>", "not_json")], [("<root>", "oneOf"), ("<root>", "type")],
        [("<root>", "maxProperties")],
    ]
    loop = {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}
    for bad in (loop, {"uniqueItems": True}, {"$ref": "http://x"}):
        with pytest.raises(ValueError):
            PS.schema_errors(bad, "text")


def test_first_error_is_by_location(spark):
    frame = spark.createDataFrame([(1, '{"b": 1, "a": {"z": 1}}'), (2, "{}"), (3, None)], "i int, text string")
    schema = {"properties": {"b": {"type": "string"}, "a": {"properties": {"z": {"type": "string"}}}}}
    rows = PS.first_schema_error(frame, ["i"], "text", schema).collect()
    assert sorted((r["i"], r["location"], r["rule"]) for r in rows) == [(1, "a/z", "type"), (3, "<root>", "not_json")]


def test_tested_members_have_the_errors_of_the_whole_search(spark):
    """Tests by plain paths pass for valid values alone, whatever else is there."""
    schema = {
        "type": "object",
        "additionalProperties": False,
        "required": ["k"],
        "properties": {
            "k": {"type": "string", "pattern": "^a"},
            "n": {"type": ["integer", "string"]},
            "e": {"enum": ["x", "y"]},
            "o": {"type": "object", "required": ["p"], "additionalProperties": False, "properties": {"p": {"const": "c"}, "q": {}}},
            "l": {"type": "array", "items": {"type": "string"}},
            "m": {"type": "object", "additionalProperties": {"type": ["number", "boolean"]}},
        },
        "allOf": [{"if": {"required": ["e"]}, "then": {"properties": {"k": {"const": "ab"}}}}],
    }
    rows = [
        {"k": "a"}, {"k": "b"}, {"k": None}, {}, {"k": "a", "z": 1}, {"k": "a", "n": 1.5}, {"k": "a", "n": 2.0}, {"k": "a", "n": None},
        {"k": "ab", "e": "x"}, {"k": "a", "e": "x"}, {"k": "a", "e": 1}, {"k": "a", "o": {"p": "c", "q": None}}, {"k": "a", "o": {"q": 1}},
        {"k": "a", "o": {"p": "c", "r": 1}}, {"k": "a", "o": None}, {"k": "a", "o": []}, {"k": "a", "l": ["s", None]}, {"k": "a", "l": []},
        {"k": "a", "l": {"0": "s"}}, {"k": "a", "m": {"u": 1, "v": True}}, {"k": "a", "m": {"u": None}}, [], None,
    ]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, text string")
    compiler = PS._Compiler(schema)
    assert set(compiler.root_tests("_json")) == {"", *schema["properties"]}
    both = PS.found_errors(frame, "text", schema).select("i", "found", PS.schema_errors(schema, "text").alias("whole")).collect()
    assert [(r["i"], r["found"]) for r in both if r["found"] != r["whole"]] == []
    assert [r["i"] for r in sorted(both) if not r["found"]] == [0, 6, 8, 11, 17, 19]


def test_documents_are_tested_outside_generators_and_array_functions(spark):
    """Generators and array functions are not compiled; a valid row needs few of them."""
    frame = spark.createDataFrame([(1, "{}")], "i int, text string")
    found = PS.found_errors(frame, "text", PS.contract_row_schema())
    plan = found._jdf.queryExecution().executedPlan().toString()
    generators = [line for line in plan.splitlines() if "Generate " in line]
    assert generators and not any("lambda" in line or "try_variant_get" in line for line in generators)


def test_held_documents_have_the_errors_of_the_whole_search(spark):
    """Conditions, names that differ by case or need quotes, kinds that texts hide, keys twice."""
    schema = {
        "type": "object",
        "additionalProperties": False,
        "required": ["a", "A"],
        "properties": {
            "a": {"type": "string"}, "A": {"type": "string"}, "b`.\\'c": {"const": "x"}, "s": {"enum": ["x", "1", "true"]},
            "t": {"type": "string"}, "o": {"type": "object", "required": ["p"], "properties": {"p": {"type": "string"}, "q": {"enum": ["1"]}}},
            "l": {"type": "array", "items": {"type": "object", "additionalProperties": False, "properties": {"v": {"type": ["integer", "string"]}}}},
            "m": {"additionalProperties": {"type": "string"}}, "n": {"type": ["number", "null"]},
        },
        "allOf": [
            {"if": {"properties": {"s": {"const": "x"}}, "required": ["s"]}, "then": {"required": ["t"]}, "else": {"not": {"required": ["t"]}}},
            {"not": {"properties": {"s": {"enum": ["true"]}}, "required": ["s", "n"]}},
        ],
    }
    base = {"a": "1", "A": "2"}
    more = [
        {}, {"s": "x"}, {"s": "x", "t": "u"}, {"t": "u"}, {"s": 1}, {"s": "1"}, {"s": True}, {"s": "true", "n": None}, {"s": "true"}, {"n": "1"}, {"n": 1.5},
        {"b`.\\'c": "x"}, {"b`.\\'c": "y"}, {"t": 5, "s": "x"}, {"o": {"p": "1", "r": 1}}, {"o": {"p": 1}}, {"o": {"p": "1", "q": 1}}, {"o": {"p": "1", "q": "1"}}, {"o": {}},
        {"l": [{"v": 1}, {"v": "1"}, {}]}, {"l": [{"v": 1.5}]}, {"l": [{"w": 1}]}, {"l": [None]}, {"m": {"x": "1"}}, {"m": {"x": 1}}, {"m": "x"}, {"z": 1},
    ]
    rows = [json.dumps(base | row) for row in more] + ['{"a": "1"}', '{"a": 1, "A": "2"}', '{"a": "1", "A": "2", "t": "1", "t": "2"}', "[1]", "null", "3", "", '{"a": [1]}']
    frame = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    both = PS.found_errors(frame, "text", schema).select("i", "found", PS.schema_errors(schema, "text").alias("whole")).collect()
    assert len(both) == len(rows)
    assert [(rows[r["i"]], r["found"], r["whole"]) for r in both if r["found"] != r["whole"]] == []
    # A text is no object, so rules about members pass it.
    assert [r["i"] for r in sorted(both) if not r["found"]] == [0, 2, 5, 8, 10, 11, 14, 17, 19, 23, 25]
