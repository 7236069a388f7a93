"""JSON schema documents compiled to one expression over variants.

``schema_errors(schema, text)`` is one expression for any depth of a schema:
objects, arrays, references and conditions become nested array functions, so a
table of JSON lines is checked in one pass and every error comes with its
location.  The expression is written as SQL text, which is far quicker to build
than thousands of column objects.

Array functions are not compiled, so ``found_errors`` first decodes a document to one
struct, tests its members and looks for errors in the members that fail only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from itertools import count
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.plans.rules import (
    ASSERTIONS,
    PROVENANCE_CLASSES,
    ROW_KEY_SPACES,
    ROW_REQUIRED,
    VALUE_TYPES,
)

ERROR = "struct<path:array<string>,rule:string,detail:string>"
ROOT = "cast(array() as array<string>)"
#: Names that a path of a variant takes as they stand.
PLAIN = "[A-Za-z_][A-Za-z0-9_]*"
_NONE = f"cast(array() as array<{ERROR}>)"

#: Words that say nothing about what is valid.
ANNOTATIONS = {
    "$schema", "$id", "$comment", "$defs", "definitions", "title", "description",
    "default", "examples", "format", "deprecated", "readOnly", "writeOnly",
}
#: Kinds of a variant that a type of the schema language stands for.
NUMBERS = ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]
KINDS = {
    "object": ["OBJECT"],
    "array": ["ARRAY"],
    "string": ["STRING"],
    "boolean": ["BOOLEAN"],
    "null": ["VOID"],
    "number": NUMBERS,
    "integer": NUMBERS,
}


def _text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _as(value: str, kind: str) -> str:
    return f"try_variant_get({value}, '$', {_text(kind)})"


def _at(value: str, name: str) -> str:
    return f"try_variant_get({value}, '$.{name}', 'variant')"


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _kind(value: str) -> str:
    return f"regexp_extract(schema_of_variant({value}), '^[A-Z]+', 0)"


def _listed(kinds: Sequence[str]) -> str:
    return ", ".join(map(_text, kinds))


def _error(path: str, rule: str, detail: str) -> str:
    return f"named_struct('path', {path}, 'rule', {_text(rule)}, 'detail', {detail})"


def _when(wrong: str, path: str, rule: str, detail: str = "''") -> str:
    """One error, or null."""
    return f"if({wrong}, {_error(path, rule, detail)}, null)"


def _gathered(own: Sequence[str], deeper: Sequence[str]) -> str:
    """Errors that are there, and arrays that are: one array."""
    parts = []
    if own:
        parts.append(f"cast(array_compact(array({', '.join(own)})) as array<{ERROR}>)")
    if deeper:
        parts.append(f"flatten(array_compact(array({', '.join(deeper)})))")
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0] if parts else _NONE


def _joined(own: Sequence[str], deeper: Sequence[str]) -> str:
    """The same without array functions, so that it is compiled."""
    alone = [f"if({error} is null, {_NONE}, array({error}))" for error in own]
    parts = [*alone, *[f"coalesce({errors}, {_NONE})" for errors in deeper]]
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0] if parts else _NONE


class Shape(NamedTuple):
    type: str  # that a value is decoded to; values of another kind become null
    test: Callable[[str], str]  # of the decoded value, as SQL


class _Compiler:
    """Every method gives SQL text; ``value``, ``kind`` and ``path`` are SQL too."""

    def __init__(self, root: Mapping[str, Any]):
        self.root, self.names = root, count()
        #: Tests of the root's members that passed, by name, as SQL; of all its keys: "";
        #: of a part of its ``allOf``: that word and the part's number.
        self.passed: dict[str | tuple[str, int], str] = {}
        #: Columns with the kind of the document and the names of its members, where they are held.
        self.held: tuple[str, str] | None = None

    def bound(self, value: str, body: Callable[[str], str]) -> str:
        """``body`` of a value that is worked out once, however often it is used."""
        name = f"x{next(self.names)}"
        return f"flatten(transform(array({value}), {name} -> {body(name)}))"

    def resolved(self, reference: str) -> Mapping[str, Any]:
        if not reference.startswith("#/"):
            raise ValueError(f"only references inside the document: {reference}")
        found: Any = self.root
        for part in reference[2:].split("/"):
            found = found[part.replace("~1", "/").replace("~0", "~")]
        return found

    def errors(self, schema: Any, value: str, path: str, open_: tuple = ()) -> str:
        """Errors of ``value``, an array that is empty for a valid one."""
        if schema is True or schema == {}:
            return _NONE
        if schema is False:
            return f"array({_error(path, 'false', _text(''))})"
        if path == ROOT and self.held:
            return self.node(schema, value, self.held[0], path, open_)
        # The kind of a value is worked out once for all rules about it.
        held = f"named_struct('value', {value}, 'kind', {_kind(value)})"
        return self.bound(held, lambda x: self.node(schema, f"{x}.value", f"{x}.kind", path, open_))

    def again(self, schema: Any, value: str, kind: str, path: str, open_: tuple) -> str:
        if schema in (True, False, {}):
            return self.errors(schema, value, path, open_)
        outer, self.passed = self.passed, {}  # they are about the document's own rules
        found = self.node(schema, value, kind, path, open_)
        self.passed = outer
        return found

    # --- tests of decoded values: true for valid ones only, null or false for others ---
    def shape(self, schema: Any, open_: tuple = ()) -> Shape | None:
        """Type to decode a value to, and its test; null where such a test cannot be written."""
        if schema is False:
            return None
        rest = {} if schema is True else {k: v for k, v in schema.items() if k not in ANNOTATIONS}
        if "$ref" in rest:
            name = rest.pop("$ref")
            return None if rest or name in open_ else self.shape(self.resolved(name), (*open_, name))
        wanted = rest.pop("type", None)
        words = ("required", "properties", "additionalProperties")
        members = {w: rest.pop(w) for w in words if w in rest}
        if wanted == "object" or members:
            return None if rest or wanted not in (None, "object") else self.object_shape(members, open_)
        if wanted == "array":
            inside = self.shape(rest.pop("items", True), open_)
            return None if rest or inside is None else self.array_shape(inside)
        kinds = [wanted] if isinstance(wanted, str) else wanted
        lists = ([rest.pop("const")] if "const" in rest else None, rest.pop("enum", None))
        lists = [values for values in lists if values is not None]
        pattern = rest.pop("pattern", None)
        if rest or not all(values and all(isinstance(v, str) for v in values) for values in lists):
            return None
        if lists or pattern is not None:
            return self.text_shape(lists, pattern) if kinds is None or "string" in kinds else None
        if kinds is None:
            return Shape("variant", lambda x: f"{x} is not null")
        return None if {"object", "array"} & set(kinds) else self.kinds_shape(kinds)

    def text_shape(self, lists: Sequence[Sequence[str]], pattern: str | None) -> Shape:
        # A number can be read as a string, but only a string as binary.
        def test(x: str) -> str:
            tests = [f"string({x}) in ({_listed(values)})" for values in lists]
            if pattern is not None:
                tests.append(f"rlike(string({x}), {_text(pattern)})")
            return " and ".join(tests)

        return Shape("binary", test)

    def kinds_shape(self, kinds: Sequence[str]) -> Shape:
        whole = "integer" in kinds and "number" not in kinds
        plain = sorted({k for name in kinds if not (whole and name == "integer") for k in KINDS[name]})

        def test(x: str) -> str:
            kind, number = f"schema_of_variant({x})", _as(x, "double")
            if whole or "DECIMAL" in plain:
                kind = f"substring_index({kind}, '(', 1)"
            fits = [f"{kind} in ({_listed(plain)})"] if plain else []
            if whole:
                fits.append(f"({kind} in ({_listed(NUMBERS)}) and {number} = rint({number}))")
            return f"({' or '.join(fits)})" if fits else "false"

        return Shape("variant", test)

    def array_shape(self, inside: Shape) -> Shape:
        item = f"x{next(self.names)}"
        return Shape(f"array<{inside.type}>", lambda x: f"forall({x}, {item} -> coalesce({inside.test(item)}, false))")

    def object_shape(self, rules: dict, open_: tuple) -> Shape | None:
        """A map of the members; their tests read them from it."""
        properties, needed = rules.get("properties", {}), rules.get("required", [])
        more = rules.get("additionalProperties", True)
        if more is False and not set(needed) <= set(properties):
            return None
        shapes = {n: self.shape(p, open_) for n, p in ({n: True for n in needed} | properties).items()}
        other = None if isinstance(more, bool) else self.shape(more, open_)
        wanted = [*shapes.values(), *([] if isinstance(more, bool) else [other])]
        if None in wanted:
            return None
        types = {shape.type for shape in wanted}
        held = "variant" if len(types) > 1 else types.pop() if types else "binary"
        entry, inner = f"x{next(self.names)}", f"x{next(self.names)}"

        def member(shape: Shape, x: str) -> str:
            found = x if shape.type == held else _as(x, shape.type)
            if not shape.type.startswith("map"):
                return shape.test(found)
            # Read once, however many members it has.
            return f"forall(array({found}), {inner} -> coalesce({shape.test(inner)}, false))"

        def test(x: str) -> str:
            has = lambda n: f"map_contains_key({x}, {_text(n)})"
            tests = [f"{x} is not null"]
            for n, shape in shapes.items():
                inside = member(shape, f"try_element_at({x}, {_text(n)})")
                tests.append(inside if n in needed else f"(not {has(n)} or {inside})")
            if more is False:
                # Members that nobody listed are more than were found.
                found = [f"int({has(n)})" for n in shapes if n not in needed]
                tests.append(f"size({x}) = {' + '.join([str(len(set(needed))), *found])}")
            elif other is not None:
                known = f"{entry}.key in ({_listed(list(properties))}) or " if properties else ""
                inside = f"coalesce({known}{member(other, f'{entry}.value')}, false)"
                tests.append(f"forall(map_entries({x}), {entry} -> {inside})")
            return " and ".join(tests)

        return Shape(f"map<string,{held}>", test)

    def root_shapes(self) -> dict[str, Shape]:
        """Shapes of the root's members by name, of names that differ by more than case."""
        properties = self.root.get("properties", {})
        lowered = [name.lower() for name in properties]
        shapes = {n: self.shape(p) for n, p in properties.items() if lowered.count(n.lower()) == 1}
        return {name: shape for name, shape in shapes.items() if shape is not None}

    def root_tests(self, value: str) -> dict[str, str]:
        """Tests of the root's members by name; under "" one of its keys alone.

        They read the columns ``{value}_keys``, the names of all members, and ``{value}_typed``, a struct.
        """
        properties, needed = self.root.get("properties", {}), self.root.get("required", [])
        given, tests = f"{value}_keys", {}
        for name, shape in self.root_shapes().items():
            found = f"{value}_typed.{_name(name)}"
            absent = f"not array_contains({given}, {_text(name)})"
            tests[name] = f"if({found} is null, {absent}, {shape.test(found)})"
        # A member that was decoded is there.
        has = lambda n: f"{value}_typed.{_name(n)} is not null" if n in tests else f"array_contains({given}, {_text(n)})"
        keys = [f"{given} is not null", *map(has, needed)]
        if self.root.get("additionalProperties") is False:
            keys.append(f"size({given}) = {' + '.join(f'int({has(n)})' for n in properties) or '0'}")
        tests[""] = " and ".join(keys)
        return tests

    def tested_by(self, tests: Mapping[str | tuple[str, int], str]) -> bool:
        """Whether a document that passes all the tests has no error."""
        rules = {k: v for k, v in self.root.items() if k not in ANNOTATIONS}
        wanted = [n for n, schema in rules.pop("properties", {}).items() if schema is not True and schema != {}]
        wanted += [("allOf", i) for i in range(len(rules.pop("allOf", [])))]
        rules.pop("required", None)
        return set(wanted) <= set(tests) and (
            rules.pop("type", "object") == "object" and isinstance(rules.pop("additionalProperties", True), bool) and not rules
        )

    def root_rule(self, rule: Any, value: str, holds: bool) -> str | None:
        """True only for documents that hold a rule about some members, or only for those that break it.

        Null where such a test cannot be written.
        """
        if isinstance(rule, bool):
            return str(rule is holds).lower()
        words = set(rule) - ANNOTATIONS
        if words == {"not"}:
            return self.root_rule(rule["not"], value, not holds)
        if "if" in words and words <= {"if", "then", "else"}:
            sides = [
                (self.root_rule(rule["if"], value, side), self.root_rule(rule.get(word, True), value, holds))
                for side, word in ((True, "then"), (False, "else"))
            ]
            if None in [test for side in sides for test in side]:
                return None
            return "(" + " or ".join(f"({of} and {then})" for of, then in sides) + ")"
        if not words <= {"required", "properties"}:
            return None
        given = lambda n: f"array_contains({value}_keys, {_text(n)})"
        tests = [given(n) for n in rule.get("required", [])]
        for name, schema in rule.get("properties", {}).items():
            shape, held = self.shape(schema), self.root_shapes().get(name)
            # What is no listed string breaks a list of strings; of other rules that is not so plain.
            listed = isinstance(schema, dict) and {*schema} in ({"const"}, {"enum"})
            if not listed or None in (shape, held) or shape.type != held.type or shape.type != "binary":
                return None
            tests.append(f"(not {given(name)} or coalesce({shape.test(f'{value}_typed.{_name(name)}')}, false))")
        # Rules about members say nothing about what is no object.
        found = f"({' and '.join(tests) or 'true'})"
        return f"({value}_keys is not null and {'' if holds else 'not '}{found})"

    def node(self, schema: Mapping[str, Any], value: str, kind: str, path: str, open_: tuple) -> str:
        deeper, own = [], []
        known = {"$ref", "if", "then", "else", "allOf", "anyOf", "oneOf", "not"}
        if "$ref" in schema:
            if schema["$ref"] in open_:
                raise ValueError(f"a schema of unbounded depth: {schema['$ref']}")
            target = self.resolved(schema["$ref"])
            deeper.append(self.again(target, value, kind, path, (*open_, schema["$ref"])))
        # Rules about the same value share its kind.
        again = lambda part: self.again(part, value, kind, path, open_)
        for i, part in enumerate(schema.get("allOf", [])):
            passed = self.passed.get(("allOf", i)) if path == ROOT else None
            deeper.append(f"if({passed}, null, {again(part)})" if passed else again(part))
        holds = lambda part: f"size({again(part)}) = 0"
        if "if" in schema:
            true, false = again(schema.get("then", True)), again(schema.get("else", True))
            deeper.append(f"if({holds(schema['if'])}, {true}, {false})")
        if "not" in schema:
            own.append(_when(holds(schema["not"]), path, "not"))
        for word in ("anyOf", "oneOf"):
            if word in schema:
                fits = f"size(filter(array({', '.join(map(holds, schema[word]))}), ok -> ok))"
                own.append(_when(f"{fits} = 0" if word == "anyOf" else f"{fits} <> 1", path, word))
        rules = {k: v for k, v in schema.items() if k not in known and k not in ANNOTATIONS}
        self.rules(rules, value, kind, path, open_, own, deeper)
        return self.gathered(path)(own, deeper)

    def gathered(self, path: str) -> Callable[[Sequence[str], Sequence[str]], str]:
        """How errors meet: those of a held document outside array functions."""
        return _joined if path == ROOT and self.held else _gathered

    def same(self, value: str, kind: str, wanted: Any) -> str:
        if wanted is None:
            return f"{kind} = 'VOID'"
        if isinstance(wanted, bool):
            return f"({kind} = 'BOOLEAN' and {_as(value, 'boolean')} = {str(wanted).lower()})"
        if isinstance(wanted, (int, float)):
            return f"({kind} in ({_listed(NUMBERS)}) and {_as(value, 'double')} = double('{wanted}'))"
        if isinstance(wanted, str):
            return f"({kind} = 'STRING' and {_as(value, 'string')} = {_text(wanted)})"
        return f"to_json({value}) = to_json(parse_json({_text(json.dumps(wanted))}))"

    def rules(self, rules: dict, value: str, kind: str, path: str, open_: tuple, own: list, deeper: list) -> None:
        """Add errors of the value itself to ``own``, arrays of errors inside it to ``deeper``."""
        shown = f"left(to_json({value}), 80)"
        number, string = _as(value, "double"), _as(value, "string")

        def check(rule: str, wrong: str) -> None:
            own.append(_when(wrong, path, rule, shown))

        if "type" in rules:
            wanted = rules.pop("type")
            fits = []
            for name in [wanted] if isinstance(wanted, str) else wanted:
                one = f"{kind} in ({_listed(KINDS[name])})"
                fits.append(f"({one} and {number} = rint({number}))" if name == "integer" else one)
            check("type", f"not coalesce({' or '.join(fits)}, false)")
        if "const" in rules:
            check("const", f"not coalesce({self.same(value, kind, rules.pop('const'))}, false)")
        if "enum" in rules:
            fits = [f"coalesce({self.same(value, kind, w)}, false)" for w in rules.pop("enum")]
            check("enum", f"not ({' or '.join(fits) or 'false'})")
        if "pattern" in rules:
            check("pattern", f"{kind} = 'STRING' and not rlike({string}, {_text(rules.pop('pattern'))})")
        for rule, sign in (("minLength", "<"), ("maxLength", ">")):
            if rule in rules:
                check(rule, f"{kind} = 'STRING' and char_length({string}) {sign} {rules.pop(rule):d}")
        for rule, sign in (("minimum", "<"), ("maximum", ">"), ("exclusiveMinimum", "<="), ("exclusiveMaximum", ">=")):
            if rule in rules:
                check(rule, f"{kind} in ({_listed(NUMBERS)}) and {number} {sign} double('{rules.pop(rule)}')")
        words = ("required", "properties", "additionalProperties", "minProperties", "maxProperties")
        members = {w: rules.pop(w) for w in words if w in rules}
        if members:
            held = _as(value, "map<string,variant>")
            if path == ROOT and self.held:
                # Few members have errors: each is read alone.
                at = lambda n: _at(value, n) if re.fullmatch(PLAIN, n) else f"try_element_at({held}, {_text(n)})"
                found = self.members(members, held, self.held[1], at, path, open_)
            else:
                at = lambda m: lambda n: f"try_element_at({m}, {_text(n)})"
                found = self.bound(held, lambda m: self.members(members, m, f"map_keys({m})", at(m), path, open_))
            deeper.append(f"if({kind} = 'OBJECT', {found}, null)")
        listed = {w: rules.pop(w) for w in ("items", "minItems", "maxItems") if w in rules}
        if listed:
            found = self.bound(_as(value, "array<variant>"), lambda a: self.items(listed, a, path, open_))
            deeper.append(f"if({kind} = 'ARRAY', {found}, null)")
        if rules:
            raise ValueError(f"not supported in a schema: {sorted(rules)}")

    def members(
        self, rules: dict, members: str, keys: str, at: Callable[[str], str], path: str, open_: tuple
    ) -> str:
        passed = self.passed if path == ROOT else {}
        tested = f"not {passed['']} and " if "" in passed else ""
        own, deeper, properties = [], [], rules.get("properties", {})
        needed = rules.get("required", [])
        if tested and needed:
            name = f"x{next(self.names)}"
            absent = f"array_except(array({_listed(needed)}), {keys})"
            deeper.append(f"if({tested}true, transform({absent}, {name} -> {_error(path, 'required', name)}), null)")
        else:
            own += [_when(f"{at(n)} is null", path, "required", _text(n)) for n in needed]
        for name, schema in properties.items():
            if schema is not True and schema != {}:
                inside = self.errors(schema, at(name), f"concat({path}, array({_text(name)}))", open_)
                untested = f"not {passed[name]} and " if name in passed else ""
                deeper.append(f"if({untested}{at(name)} is not null, {inside}, null)")
        more = rules.get("additionalProperties", True)
        named = f"cast(array({_listed(list(properties))}) as array<string>)"
        if more is False:
            rest = f"array_except({keys}, {named})"
            own.append(_when(f"{tested}size({rest}) > 0", path, "additionalProperties", f"array_join({rest}, ', ')"))
        elif more is not True:
            entry, key = f"x{next(self.names)}", f"k{next(self.names)}"
            inside = self.errors(more, f"{entry}.value", f"concat({path}, array({entry}.key))", open_)
            rest = f"map_entries(map_filter({members}, ({key}, _) -> not array_contains({named}, {key})))"
            deeper.append(f"flatten(transform({rest}, {entry} -> {inside}))")
        for rule, sign in (("minProperties", "<"), ("maxProperties", ">")):
            if rule in rules:
                own.append(_when(f"size({keys}) {sign} {rules[rule]:d}", path, rule))
        return self.gathered(path)(own, deeper)

    def items(self, rules: dict, items: str, path: str, open_: tuple) -> str:
        own, deeper = [], []
        if "items" in rules:
            item, at = f"x{next(self.names)}", f"i{next(self.names)}"
            inside = self.errors(rules["items"], item, f"concat({path}, array(string({at})))", open_)
            deeper.append(f"flatten(transform({items}, ({item}, {at}) -> {inside}))")
        for rule, sign in (("minItems", "<"), ("maxItems", ">")):
            if rule in rules:
                own.append(_when(f"size({items}) {sign} {rules[rule]:d}", path, rule))
        return _gathered(own, deeper)


def schema_errors(schema: Mapping[str, Any], text: str) -> Column:
    """``array<struct<path, rule, detail>>`` of the JSON in column ``text``, in
    order of location.

    Text that is no JSON is the error ``not_json`` at the root.  A reference back
    into a schema that is being compiled, and a rule that is not supported, are
    errors when the schema is compiled.
    """
    compiler = _Compiler(schema)
    found = compiler.bound(
        f"try_parse_json(`{text}`)",
        lambda v: f"if({v} is null, {_broken(text)}, {compiler.errors(schema, v, ROOT)})",
    )
    return F.array_sort(F.expr(found))


def _broken(text: str) -> str:
    return f"array({_error(ROOT, 'not_json', f'left(`{text}`, 80)')})"


def found_errors(lines: DataFrame, text: str, schema: Mapping[str, Any], found: str = "found") -> DataFrame:
    """``lines`` with ``schema_errors`` in ``found``, looked for where a test failed only."""
    compiler = _Compiler(schema)
    compiler.errors(schema, "x", ROOT)  # a schema that cannot be compiled is an error first
    shapes, tests = compiler.root_shapes(), compiler.root_tests("_json")
    for i, part in enumerate(schema.get("allOf", [])):
        if test := compiler.root_rule(part, "_json", True):
            tests["allOf", i] = test
    typed = ",".join(f"{_name(name)}:{shape.type}" for name, shape in shapes.items())
    # One column per step: each is worked out once and used by the next ones.
    parsed = lines.select("*", F.expr(f"try_parse_json(`{text}`)").alias("_json"))
    # Only the names are wanted, so values are read as what few of them are: null at once.
    keys = "map_keys(try_variant_get(_json, '$', 'map<string,array<boolean>>'))"
    struct = [F.expr(_as("_json", f"struct<{typed}>")).alias("_json_typed")] if shapes else []
    decoded = parsed.select("*", F.expr(keys).alias("_json_keys"), *struct)
    kind = f"if(_json_keys is not null, 'OBJECT', {_kind('_json')})"
    flags = [F.expr(f"coalesce({test}, false)").alias(f"_t{i}") for i, test in enumerate(tests.values())]
    tested = decoded.select("*", F.expr(kind).alias("_json_kind"), *flags)
    compiler.passed = {name: f"_t{i}" for i, name in enumerate(tests)}
    compiler.held = "_json_kind", "_json_keys"
    errors = f"if(_json is null, {_broken(text)}, {compiler.errors(schema, '_json', ROOT)})"
    if compiler.tested_by(tests):
        errors = f"if({' and '.join(compiler.passed.values())}, {_NONE}, {errors})"
    # Sorting is an array function as well: few rows need it.
    sought = tested.select(*lines.columns, F.expr(errors).alias("_errors"))
    ordered = F.when(F.size("_errors") < 2, F.col("_errors")).otherwise(F.array_sort("_errors"))
    sought = sought.select(*lines.columns, ordered.alias(found))
    # A generator, so that filters of the errors do not search again.
    return sought.select(*lines.columns, F.explode(F.array(found)).alias(found))


def validate_rows(lines: DataFrame, keep: Sequence[str], text: str, schema: Mapping[str, Any]) -> DataFrame:
    """``keep, location, rule, detail``: one row per error; the root is ``<root>``."""
    found = found_errors(lines, text, schema, "_found").select(*keep, F.inline("_found"))
    return found.select(*keep, _location(F.col("path")).alias("location"), "rule", "detail")


def first_schema_error(lines: DataFrame, keep: Sequence[str], text: str, schema: Mapping[str, Any]) -> DataFrame:
    """The first error of each invalid row by location, then rule and detail."""
    found = found_errors(lines, text, schema, "_found")
    found = found.select(*keep, F.inline(F.slice("_found", 1, 1)))
    return found.select(*keep, _location(F.col("path")).alias("location"), "rule", "detail")


def _location(path: Column) -> Column:
    return F.when(F.size(path) == 0, "<root>").otherwise(F.array_join(path, "/"))


# --- fixed values: the contract row, field by field ---------------------------------
SCALAR = {"type": ["integer", "number", "string", "boolean"]}
TEXT = {"type": "string"}
TEXTS = {"type": "array", "items": TEXT}
SOURCE_TEXTS = [
    "source_name", "source_table", "source_file", "vintage", "extracted_at",
    "extraction_method", "source_sha256", "raw_uri",
]
PERIOD_BASES = ["calendar", "tax", "fiscal", "survey_reference", "projection_horizon"]
ACCOUNTING_BASES = ["cash", "accrual"]
# --------------------------------------------------------------------------------------


def _closed(required: Sequence[str], optional: Sequence[str] = (), **special: Any) -> dict:
    """An object of text fields without others; ``special`` has fields of other kinds."""
    fields = {name: TEXT for name in [*required, *optional]} | special
    return {
        "type": "object",
        "additionalProperties": False,
        "required": list(required),
        "properties": fields,
    }


def key_schema(space: str) -> dict:
    return {"type": "string", "pattern": "^" + space.replace(".", "\\.") + ":[0-9a-f]{24}$"}


def contract_row_schema(version: str = "consumer_fact.v1") -> dict:
    """The schema document of a contract row in this library's key spaces."""
    surveyed = {"properties": {"provenance_class": {"const": "survey_aggregate"}}, "required": ["provenance_class"]}
    named = {"required": ["survey_instrument"]}
    constraint = _closed(["variable", "operator", "value", "role"], ["unit"], value=SCALAR)
    open_object = {"type": "object", "additionalProperties": True}
    properties = {
        "schema_version": {"const": version},
        **{name: key_schema(space) for name, space in ROW_KEY_SPACES.items()},
        "value": SCALAR,
        "value_type": {"enum": list(VALUE_TYPES)},
        "assertion": {"type": "string", "enum": list(ASSERTIONS)},
        "provenance_class": {"type": "string", "enum": list(PROVENANCE_CLASSES)},
        "survey_instrument": {"type": "string", "pattern": r"\S"},
        "period": _closed(["type", "value"], value={"type": ["integer", "string"]}),
        "period_coverage": _closed(
            [],
            ["start_date", "end_date", "source_period_label", "notes"],
            basis={"type": "string", "enum": PERIOD_BASES},
            accounting_basis={"type": "string", "enum": ACCOUNTING_BASES},
        ),
        "geography": _closed(["level", "id"], ["vintage"]),
        "entity": _closed(["name"], ["role"]),
        "aggregation": _closed(["method"], ["denominator"]),
        "observed_measure": _closed(["source_name", "source_table", "source_measure_id", "source_concept", "unit"]),
        "dimensions": {"type": "object", "additionalProperties": SCALAR},
        "universe_constraints": _closed(
            ["domain"], constraints={"type": "array", "items": {"$ref": "#/$defs/constraint"}}
        ),
        "source": {
            **open_object,
            "required": [*SOURCE_TEXTS, "source_size_bytes"],
            "properties": {
                **{n: TEXT for n in [*SOURCE_TEXTS, "url", "method_notes", "raw_bucket", "raw_key"]},
                "source_size_bytes": {"type": "integer"},
            },
        },
        "lineage": _closed(
            ["source_record_id", "source_cell_keys"], source_cell_keys=TEXTS, source_row_keys=TEXTS
        ),
        "layout": open_object,
        "label": TEXT,
        "concept_alignment": _closed(
            ["concept_alignment_key", "source_concept", "canonical_concept", "relation", "authority"],
            ["evidence_url", "evidence_notes", "legal_vintage"],
            concept_alignment_key=key_schema("concept_alignment.v2"),
        ),
    }
    return {
        "type": "object",
        "additionalProperties": False,
        "required": list(ROW_REQUIRED),
        "allOf": [{"if": surveyed, "then": named, "else": {"not": named}}],
        "properties": properties,
        "$defs": {"constraint": constraint},
    }
