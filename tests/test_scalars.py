import pytest
from pyspark.sql import functions as F

from factloom.functions import bands as B
from factloom.functions import scalars as S


def evaluate(spark, make, values):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "i int, x string")
    found = frame.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()
    return [row["y"] for row in found]


@pytest.mark.parametrize(
    ("text", "kind", "num"),
    [
        ("", "empty", None),
        (" 5 ", "number", 5.0),
        ("$1,234", "number", 1234.0),
        ("1_000", "text", None),
        ("01", "number", 1.0),
        ("-3", "number", -3.0),
        ("--5", "text", None),
        ("1e3", "number", 1000.0),
        ("1d", "text", None),
        ("nan", "text", None),
        ("inf", "text", None),
        ("n/a", "text", None),
        (None, "empty", None),
    ],
)
def test_typed_scalar(spark, text, kind, num):
    found = evaluate(spark, S.typed_scalar, [text])[0]
    assert (found["kind"], found["num"]) == (kind, num)


def test_typed_scalar_keeps_original_text(spark):
    assert evaluate(spark, S.typed_scalar, [" 01 "])[0]["text"] == "01"


def test_scaled_number(spark):
    texts = ["£1,234", "2.5 million", "3bn", "-4 thousand", "$0.5 Billion"]
    assert evaluate(spark, S.scaled_number, texts) == [1234, 2.5e6, 3e9, -4e3, 5e8]


def test_column_letters_round_trip(spark):
    numbers = [1, 26, 27, 52, 702, 703, 16384, 18278, 18279]
    frame = spark.createDataFrame([(n,) for n in numbers], "n long")
    letters = frame.withColumn("a", S.column_letters(F.col("n"))).withColumn(
        "back", S.column_number(F.col("a"))
    )
    found = {row["n"]: (row["a"], row["back"]) for row in letters.collect()}
    assert found[16384] == ("XFD", 16384)
    assert all(n == back for n, (_, back) in found.items())


def test_age_bands(spark):
    labels = [
        "Aged 5-9",
        "Aged 5 to 9",
        "Female 18 and 19 years",
        "Age 85 and over",
        "Aged 7 years",
        "12",
        "12.0",
        "12.5",
        "Total",
        "Female 85 and over",
    ]
    found = [b and (b["lo"], b["hi"]) for b in evaluate(spark, B.age_band, labels)]
    assert found == [
        (5, 10),
        (5, 10),
        (18, 20),
        (85, None),
        (7, 8),
        (12, 13),
        (12, 13),
        None,
        None,
        None,
    ]


def test_age_codes(spark):
    found = evaluate(spark, B.age_code_band, ["POP_7", "pop_85", "POP_x"])
    assert [b and (b["lo"], b["hi"]) for b in found] == [(7, 8), (85, None), None]


def test_income_bounds(spark):
    labels = ["all", "under_1k", "1m_plus", "10k_to_25k", "odd_to_even", "x", "k_plus"]
    found = evaluate(spark, B.income_bounds, labels)
    assert [b and (b["lo"], b["hi"]) for b in found] == [
        (None, None),
        (None, 1000.0),
        (1e6, None),
        (10000.0, 25000.0),
        None,
        None,
        None,
    ]


@pytest.mark.parametrize(
    ("bands", "adjacent"),
    [
        ([(0, 5), (5, 10)], True),
        ([(5, 10), (0, 5), (5, 10)], True),
        ([(0, 5), (6, 10)], False),
        ([(0, 6), (5, 10)], False),
        ([(0, 5), (5, None)], True),
        ([(0, None), (5, 10)], False),
        ([], False),
    ],
)
def test_adjacent_bands(spark, bands, adjacent):
    frame = spark.createDataFrame([(bands,)], f"b array<{B.BAND}>")
    assert frame.select(B.adjacent_bands(F.col("b"))).first()[0] is adjacent


@pytest.mark.parametrize(
    ("operator", "expected", "ok"),
    [
        (">=", "5", True),
        (">", "4", True),
        (">", "5", False),
        ("<", "10", True),
        ("<=", "9", True),
        ("<=", "8", False),
        ("==", "5", False),
        (">=", "x", False),
    ],
)
def test_bands_match(spark, operator, expected, ok):
    frame = spark.createDataFrame([([(5, 7), (7, 10)],)], f"b array<{B.BAND}>")
    test = B.bands_match(F.col("b"), F.lit(operator), F.lit(expected))
    assert frame.select(test).first()[0] is ok


def test_operator_match_non_numbers_are_false(spark):
    frame = spark.createDataFrame(
        [("a", ">", "1"), (None, "<=", "2"), ("2.0", "==", "2"), (None, "!=", "x")],
        "s string, o string, e string",
    )
    found = frame.select(S.operator_match(F.col("s"), F.col("o"), F.col("e")))
    assert [row[0] for row in found.collect()] == [False, False, True, True]


def test_stable_slug(spark):
    assert evaluate(
        spark, lambda x: S.stable_slug(F.lit("/A b/"), F.lit(""), x), ["(C), d"]
    ) == ["a_b/c_d"]


def test_render_template(spark):
    frame = spark.createDataFrame(
        [("{year}", 2023), ("0{year}", 2023), ("F{filing_year}", 2023)], "t string, y int"
    )
    done = frame.withColumn("r", S.render_template(F.col("t"), F.col("y")))
    found = done.select("r", S.rendered_number(F.col("r"))).collect()
    assert [tuple(row) for row in found] == [
        ("2023", 2023),
        ("02023", None),
        ("F2024", None),
    ]


def test_letters_and_numbers_past_their_old_limits(spark):
    from factloom.operators import selectors as L

    def letters(n):
        out = ""
        while n:
            n, rest = divmod(n - 1, 26)
            out = chr(65 + rest) + out
        return out

    numbers = [1, 26, 27, 9_000_000_000, 2**53 + 3, 2**63 - 1]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long")
    found = rows.select("n", S.column_letters(F.col("n")).alias("l")).collect()
    assert all(r["l"] == letters(r["n"]) for r in found)
    text = spark.createDataFrame([(4e15,), (2.5,), (-3.0,)], "x double")
    texts = text.select(S.number_text(F.col("x")).alias("t")).collect()
    assert [r["t"] for r in texts] == ["4000000000000000", "2.5", "-3"]
    ranges = spark.createDataFrame([(1, 1, 2)], "range_id int, row_from int, row_to int")
    cells = spark.createDataFrame([(1, 4e-7), (2, 4e-7)], "row int, value_num double")
    total = L.sum_row_ranges(ranges, cells, []).first()["value"]
    assert abs(total - 8e-7) < 1e-15


def test_column_letters_sql_has_no_largest_number(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from factloom.suite import ORACLES, QUERIES

    keys = [0, 25, 26, 701, 702, 18277, 18278, 89_999, 475_253, 475_254, 10**12]
    spark.createDataFrame([(k,) for k in keys], "o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
        expected = duck.sql(ORACLES["fn09_column_letters"]).fetchall()
    mine = [tuple(r) for r in QUERIES["fn09_column_letters"](spark, str(tmp_path)).collect()]
    assert sorted(mine) == sorted(expected) and len(mine) == len(keys)
    assert {r[0]: r[1] for r in mine}[18279] == "AAAA"
