"""Records across lines and splits against Python's own readers."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from factloom.sources import delimited as D
from factloom.sources import records as R


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def plain_rows(text, delimiter=","):
    """Row number and name to text, as Python's csv reader has them."""
    reader = csv.reader(io.StringIO(text.removeprefix("﻿")), delimiter=delimiter)
    names = [n.strip().removeprefix("%") for n in next(reader)]
    found = {}
    for at, row in enumerate(reader, start=2):
        found[at] = {n: (row[i].strip() or None) if i < len(row) else None for i, n in enumerate(names)}
    return found


def spark_rows(frame):
    return {r["row_number"]: {v["name"]: v["text"] for v in r["values"]} for r in frame.collect()}


def test_quoted_records_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(5)
    cells = ["a", "", "7", '"q"', '"two\nlines"', '"a, ""b""\r\n\r\nc"', 'in"side', '"x"y', '""', '"\n\n"', " s ", "é"]
    for round_, end in enumerate(["\n", "\r\n"]):
        lines = ["﻿ %k,v ,w,v", "", "short"]
        lines += [",".join(rng.choice(cells) for _ in range(rng.randint(1, 5))) for _ in range(800)]
        text = end.join(lines) + end * (round_ == 0)
        rows, issues = R.delimited_rows(spark, write(tmp_path / f"{round_}.csv", text))
        assert spark_rows(rows) == plain_rows(text)
        assert issues.count() == 0
    pieces = R.split_pieces(spark, str(tmp_path / "0.csv"), "\n")
    assert pieces.select("start").distinct().count() > 5


def test_files_of_several_headers_in_one_pass(spark, tmp_path):
    texts = {"a": 'x,y\n1,"p\nq"\n', "b": "y,z\n2\n\n", "c": "only\n", "d": "x,y\n3,4"}
    for name, text in texts.items():
        write(tmp_path / f"{name}.csv", text)
    found = {}
    for r in R.delimited_rows(spark, str(tmp_path))[0].collect():
        name = r["file"].rsplit("/", 1)[1][0]
        found.setdefault(name, {})[r["row_number"]] = {v["name"]: v["text"] for v in r["values"]}
    assert found == {n: plain_rows(t) for n, t in texts.items() if n != "c"}


def test_long_and_open_records_are_issues(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'k,v\n1,ok\n2,"' + "long\n" * 50 + '"\n3,' + "x" * 300 + '\n4,"open\nend')
    rows, issues = R.delimited_rows(spark, path, longest=100)
    assert set(spark_rows(rows)) == {2, 5} and spark_rows(rows)[5]["v"] == "open\nend"
    assert sorted((r["record"], r["code"]) for r in issues.collect()) == [
        (3, "record_too_long"), (4, "record_too_long"), (5, "quote_left_open")
    ]
    tabs = write(tmp_path / "a.tsv", 'k\tv\n1\t"a\tb"\n')
    assert spark_rows(D.read_delimited(spark, tabs, "\t")) == {2: {"k": "1", "v": "a\tb"}}
    assert D.read_delimited(spark, write(tmp_path / "e.csv", "")).count() == 0


def item_texts(spark, path):
    rows, issues = R.json_items(spark, path)
    found = sorted((r["item"], r["kind"], json.loads(r["text"]) if r["kind"] == "array" else r["text"]) for r in rows.collect())
    return found, [tuple(r)[1:] for r in issues.collect()]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_file_in_many_tasks(spark, tmp_path, small_splits, indent):
    rng = random.Random(9)
    nasty = ['q"uo,te', "[{", "\\", '\\",', "}]", "é,\n", ""]

    def value(depth):
        pick = rng.random()
        if depth and pick < 0.3:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        if depth and pick < 0.6:
            return {rng.choice(nasty) + str(i): value(depth - 1) for i in range(rng.randint(0, 3))}
        return rng.choice([rng.choice(nasty), 1.5, 7, None, True])

    data = [value(3) for _ in range(300)]
    path = write(tmp_path / "a.json", json.dumps(data, indent=indent, ensure_ascii=False))
    found, issues = [], []
    rows, broken = R.json_items(spark, path)
    for r in sorted(rows.collect(), key=lambda r: r["item"]):
        found.append(json.loads(r["text"]))
    assert found == data and broken.count() == 0
    assert R.split_pieces(spark, path, ",").select("start").distinct().count() > 3


def test_broken_items_leave_the_others(spark, tmp_path):
    text = '[{"b": 1, "%a ": " $2,000 "}, {"a": 3}, 4, {"b": true, "%a ": null}, {bad}, {"b": [1], "c": 2}]'
    items, issues = R.json_items(spark, write(tmp_path / "a.json", text))
    rows, more = R.table_rows(items, ["file"])
    found = sorted((r["row_number"], r["position"], r["name"], r["kind"], r["text"], r["num"]) for r in rows.collect())
    assert found == [
        (1, 1, "b", "number", "1", 1.0), (1, 2, "a", "number", "$2,000", 2000.0),
        (2, 1, "b", "empty", None, None), (2, 2, "a", "empty", None, None),
        (4, 1, "b", "flag", "true", None), (4, 2, "a", "empty", None, None),
        (6, 1, "b", "text", "[1]", None), (6, 2, "a", "empty", None, None),
    ]
    assert sorted((r["item"], r["code"]) for r in more.collect()) == [(3, "row_shape"), (5, "not_json")]
    assert issues.count() == 0
    items, issues = R.json_items(spark, write(tmp_path / "cut.json", '[[" k","%v"],["1",2],["x'))
    rows, more = R.table_rows(items, ["file"])
    assert [(r["row_number"], r["name"], r["text"]) for r in rows.collect()] == [(2, "k", "1"), (2, "v", "2")]
    assert [r["code"] for r in issues.collect()] == ["json_left_open"]
    assert [r["code"] for r in more.collect()] == ["not_json"]
    for text in ("[]", " [ ] ", "{}"):
        assert R.json_items(spark, write(tmp_path / "none.json", text))[0].count() == 0


def test_json_documents_in_a_column(spark):
    docs = [(1, '[{"b":1,"a":"x"},{"a":2},3]'), (2, "[1,"), (3, None), (4, "[]"), (5, '[["h"],["1","2"],[]]'), (6, '{"a":1}')]
    frame = spark.createDataFrame(docs, "id int, doc string")
    rows, issues = R.json_documents(frame, ["id"], "doc")
    found = sorted((r["id"], r["row_number"], r["position"], r["name"], r["text"]) for r in rows.collect())
    assert found == [
        (1, 1, 1, "b", "1"), (1, 1, 2, "a", "x"), (1, 2, 1, "b", None), (1, 2, 2, "a", "2"),
        (5, 2, 1, "h", "1"), (5, 3, 1, "h", None),
    ]
    assert sorted((r["id"], r["item"] or 0, r["code"]) for r in issues.collect()) == [
        (1, 3, "row_shape"), (2, 0, "not_json"), (3, 0, "not_json"), (6, 0, "not_json")
    ]


def test_landed_objects(spark, tmp_path):
    text = '{"a": {"x": 1, "y": [2, 3]}, "b": "t", "c": {"z": null, "x": 5}}'
    rows, issues = R.landed_json(spark, write(tmp_path / "o.json", text))
    found = {r["row_number"]: json.loads(r["values_json"]) for r in rows.collect()}
    empty = {"key": None, "x": None, "y": None, "value": None, "z": None}
    assert found == {
        1: empty | {"key": "a", "x": "1", "y": "[2,3]"},
        2: empty | {"key": "b", "value": '"t"'},
        3: empty | {"key": "c", "x": "5"},
    }
    assert issues.count() == 0
    rows, _ = R.landed_json(spark, write(tmp_path / "l.json", '[{"a": 1}, {"b": "x"}]'))
    found = {r["row_number"]: json.loads(r["values_json"]) for r in rows.collect()}
    assert found == {1: {"a": "1", "b": None}, 2: {"a": None, "b": "x"}}
    rows, _ = R.landed_json(spark, write(tmp_path / "v.json", " 12 "))
    assert [r["values_json"] for r in rows.collect()] == ['{"value":"12"}']


def test_values_are_worked_out_once_per_row(spark, tmp_path):
    """The fields of a row are parsed once, not once per use of each value."""
    (tmp_path / "a.csv").write_text("id,note,price\n1,x,$2\n3,_4,\n")
    rows, _ = R.delimited_rows(spark, str(tmp_path))
    plan = rows.select("file", F.inline("values"))._jdf.queryExecution().optimizedPlan().toString()
    # Four uses for the headers and one for the rows (15 where each value parses again).
    assert plan.count("regexp_extract_all") <= 5
    found = {r["row_number"]: [(v["kind"], v["text"], v["num"]) for v in r["values"]] for r in rows.collect()}
    assert found == {
        2: [("number", "1", 1.0), ("text", "x", None), ("number", "$2", 2.0)],
        3: [("number", "3", 3.0), ("text", "_4", None), ("empty", None, None)],
    }
