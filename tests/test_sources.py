import hashlib
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import FOLDER
from factloom.plans import rules as PRU
from factloom.sources import delimited as D
from factloom.sources import pages as G
from factloom.sources import store as ST


def test_read_delimited(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        "﻿%name, value ,value\n"
        '"x, ""y""",1,2\n'
        "short\n"
        "z,3,$4,surplus\n"
        ",5,01\n",
        encoding="utf-8",
    )
    rows = D.read_delimited(spark, str(path)).orderBy("row_number").collect()
    found = [
        (r["row_number"], {v["name"]: (v["text"], v["num"]) for v in r["values"]})
        for r in rows
    ]
    assert found == [
        (2, {"name": ('x, "y"', None), "value": ("2", 2.0)}),
        (3, {"name": ("short", None), "value": (None, None)}),
        (4, {"name": ("z", None), "value": ("$4", 4.0)}),
        (5, {"name": (None, None), "value": ("01", 1.0)}),
    ]


def test_file_lines_over_many_splits(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("".join(f"line {i}\n" for i in range(1, 20001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = D.file_lines(spark, str(path))
        wrong = lines.filter(
            F.concat(F.lit("line "), F.col("line_number")) != F.col("line")
        )
        assert lines.count() == 20000
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_land_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("state,value\nCA,1\nNY,2\n")
    (tmp_path / "t.json").write_text('[["a","b"],["1","x"],["2","y"]]')
    (tmp_path / "o.json").write_text('[{"a": 1, "b": null}, {"a": 2}]')
    (tmp_path / "p.html").write_text("<p>\n</p>\n")

    def land(name):
        rows = D.land_file(spark, str(tmp_path / name)).orderBy("row_number").collect()
        return [(r["row_number"], r["values_json"]) for r in rows]

    assert land("t.csv") == [
        (1, '{"state":"CA","value":"1"}'),
        (2, '{"state":"NY","value":"2"}'),
    ]
    assert land("t.json") == [(1, '{"a":"1","b":"x"}'), (2, '{"a":"2","b":"y"}')]
    assert land("o.json") == [(1, '{"a":"1","b":null}'), (2, '{"a":"2","b":null}')]
    assert land("p.html")[0] == (1, '{"line_number":1,"line":"<p>"}')


def test_json_lines_round_trip(spark, tmp_path):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").drop("o_orderdate")
    D.write_json_lines(orders, str(tmp_path / "o"))
    schema = T.StructType(sorted(orders.schema.fields, key=lambda f: f.name))
    back = D.read_json_lines(spark, str(tmp_path / "o"), schema)
    assert back.exceptAll(orders.select(*back.columns)).count() == 0
    assert back.count() == orders.count()


def test_bad_json_lines(spark):
    lines = spark.createDataFrame(
        [(1, '{"a": 1}'), (2, ""), (3, "{"), (4, "[1]")], "line_number int, line string"
    )
    found = D.bad_json_lines(lines).collect()
    assert sorted(r["line_number"] for r in found) == [3, 4]


def test_html_grid_with_spans_and_nested_table(spark):
    html = (
        "<h2>A<br>b</h2><p></p><ul><li>one</li></ul>"
        "<table><tr><th colspan=2>H</th><th></th></tr>"
        "<tr><td>1,250</td><td>x &amp; y</td><td> </td></tr>"
        "<tr><td></td></tr></table>"
        "<table><tr><td>outer <table><tr><td>inner</td></tr></table></td></tr></table>"
        "<table><tr><td></td></tr></table><p>tail"
    )
    pages = spark.createDataFrame([(7, html), (8, None)], "page_id long, html string")
    pieces = G.page_pieces(pages, "page_id", "html")
    cells = {
        (r["sheet"], r["row"], r["col"]): (r["text"], r["num"])
        for r in G.page_cells(pieces).collect()
    }
    assert {k: v for k, v in cells.items() if k[0] == 1} == {
        (1, 1, 1): ("H", None),
        (1, 1, 2): ("H", None),
        (1, 2, 1): ("1,250", 1250.0),
        (1, 2, 2): ("x & y", None),
    }
    blocks = G.page_blocks(pieces).orderBy("element_index").collect()
    assert [(r["tag"], r["text"]) for r in blocks] == [("h2", "A b"), ("li", "one")]


def test_number_mentions_equal_python_regex(spark):
    pattern = re.compile(
        r"(?<![\w.])[£$€]?-?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"
        r"(?:\s*(?:thousand|million|billion)|bn)?(?![\w.])",
        re.IGNORECASE,
    )
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame(
        [(-1, "£1,234 and 2.5 Million, é5 x7 8.9.1 3bn\n\n(40) -6% 1,23")],
        "doc_id long, text string",
    )
    docs = docs.select("doc_id", "text").unionByName(extra)
    lines = G.context_lines(docs, ["doc_id"], "text")
    found = G.number_mentions(lines, ["doc_id", "line_number", "context"], "line").collect()
    expected, contexts = [], {}
    for row in docs.collect():
        kept = [
            (n, " ".join(line.replace("\xa0", " ").split()))
            for n, line in enumerate(row["text"].split("\n"), 1)
        ]
        kept = [(n, line) for n, line in kept if line]
        for at, (n, line) in enumerate(kept):
            near = kept[max(0, at - 2) : at + 3]
            contexts[(row["doc_id"], n)] = " ".join(text for _, text in near)
            for k, match in enumerate(pattern.finditer(line), 1):
                expected.append((row["doc_id"], n, k, match.group(0)))
    mine = [(r["doc_id"], r["line_number"], r["mention"], r["number_text"]) for r in found]
    assert sorted(mine) == sorted(expected)
    assert all(contexts[(r["doc_id"], r["line_number"])] == r["context"] for r in found)


def test_export_and_manifest(spark, tmp_path):
    part = spark.read.parquet(f"{FOLDER}/part.parquet")
    report = ST.export_tables({"part": part}, {"part": ["p_partkey"]}, str(tmp_path))
    assert report.first()["row_count"] == part.count()
    back = spark.read.json(str(tmp_path / "part"))
    assert back.select(*part.columns).exceptAll(
        part.withColumn("p_size", F.col("p_size").cast("long"))
    ).count() == 0


def test_stored_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    files = PRU.stored_files(spark, str(tmp_path))
    manifest = spark.createDataFrame(
        [(1, "a.bin", None, True), (2, "b.bin", "x", None), (3, "", None, None)],
        "entry int, filename string, sha256 string, linked boolean",
    )
    found = {r["entry"]: r["issue"] for r in PRU.file_inventory(manifest, files).collect()}
    assert found == {1: None, 2: "missing_file", 3: "missing_filename"}


def test_files_are_known_by_their_path_and_hashed_as_streams(spark, tmp_path):
    bodies = {"one/a b.bin": b"abc", "two/a b.bin": b"xyz", "two/\u00e9%20.bin": b"", "big.bin": None}
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body or b"")
    size = 2**31 + 5
    with open(tmp_path / "big.bin", "wb") as big:
        big.truncate(size)
    digest = hashlib.sha256()
    for _ in range(2**31 // 2**24):
        digest.update(bytes(2**24))
    digest.update(bytes(5))
    expected = {n: hashlib.sha256(b).hexdigest() for n, b in bodies.items() if b is not None}
    expected["big.bin"] = digest.hexdigest()
    files = PRU.stored_files(spark, str(tmp_path))
    found = {r["filename"]: (r["actual_sha256"], r["size_bytes"]) for r in files.collect()}
    sizes = {n: size if b is None else len(b) for n, b in bodies.items()}
    assert found == {n: (expected[n], sizes[n]) for n in bodies}
    rows = [(i, name, expected["one/a b.bin"], None) for i, name in enumerate(sorted(bodies)[1:3])]
    manifest = spark.createDataFrame(rows, "entry int, filename string, sha256 string, linked boolean")
    issues = {r["entry"]: r["issue"] for r in PRU.file_inventory(manifest, files).collect()}
    assert issues == {0: None, 1: "checksum_mismatch"}


def test_each_file_has_its_own_header_and_blank_records_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n\n3,4\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    rows = D.read_delimited(spark, str(tmp_path)).collect()
    found = sorted(
        (r["file"][-5:], r["row_number"], sorted((v["name"], v["text"]) for v in r["values"]))
        for r in rows
    )
    assert found == [
        ("a.csv", 2, [("x", "1"), ("y", "2")]),
        ("a.csv", 3, [("x", None), ("y", None)]),
        ("a.csv", 4, [("x", "3"), ("y", "4")]),
        ("b.csv", 2, [("x", "1"), ("y", "2")]),
    ]


def test_a_json_object_lands_its_entries(spark, tmp_path):
    (tmp_path / "k.json").write_text('{"a": 1, "b": {"c": 2}}')
    rows = D.land_file(spark, str(tmp_path / "k.json")).orderBy("row_number").collect()
    assert [(r["row_number"], r["values_json"]) for r in rows] == [
        (1, '{"key":"a","value":"1","c":null}'),
        (2, '{"key":"b","value":null,"c":"2"}'),
    ]


def test_upsert_with_null_key_parts(spark):
    stored = spark.createDataFrame([(1, None, "a"), (2, "x", "b")], "k int, p string, v string")
    loaded = spark.createDataFrame([(1, None, "c"), (3, None, "d")], "k int, p string, v string")
    found = ST.upsert(stored, loaded, ["k", "p"]).collect()
    assert sorted(map(tuple, found), key=str) == [(1, None, "c"), (2, "x", "b"), (3, None, "d")]
    counts = ST.upsert_counts(stored, loaded, ["k", "p"]).first()
    assert tuple(counts) == (1, 1)
