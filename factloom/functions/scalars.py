"""Scalar functions: text typing, names, labels, periods, slugs and predicates.

Each function maps Columns to a Column and stays inside generated code; none
uses Python in the executors.  Text that cannot be read gives null, never an
error, so that callers can report it as an issue row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
MONTH_NUMBERS = {
    "January": 1,
    "February": 2,
    "March": 3,
    "April": 4,
    "May": 5,
    "June": 6,
    "July": 7,
    "August": 8,
    "September": 9,
    "October": 10,
    "November": 11,
    "December": 12,
}
NUMBER_WORDS = {
    "thousand": 1_000,
    "million": 1_000_000,
    "billion": 1_000_000_000,
    "bn": 1_000_000_000,
}
YEAR_FROM, YEAR_TO = 1900, 2035
# ----------------------------------------------------------------------------

INTEGER_PATTERN = r"^-?[0-9]+$"
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2007\u202f\u2028\u2029"


def strip(text: Column) -> Column:
    """Trim every kind of white space, as opposed to blanks only."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a ``value`` that is worked out once, however often it is used.

    The optimizer puts a column's expression in place of each use inside a lambda
    function; a lambda's own variable stays one value.
    """
    return F.get(F.transform(F.array(value), make), F.lit(0))


def finite_number(text: Column) -> Column:
    """Decimal literal to double; anything else, NaN and infinity give null."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def number_text(num: Column) -> Column:
    """One spelling per number: whole numbers without a fraction part."""
    # Beyond a long every double is whole; such numbers keep Spark's spelling.
    whole = (F.abs(num) < F.lit(9.2e18)) & (num == F.rint(num))
    return F.when(whole, num.cast("bigint").cast("string")).otherwise(
        num.cast("string")
    )


def typed_scalar(text: Column) -> Column:
    """Read delimited text as ``struct<kind, text, num>``.

    Currency signs and thousands commas are dropped before the number test;
    text with an underscore is never a number.  ``text`` keeps the trimmed
    original so that codes such as ``01`` survive.
    """
    trimmed = strip(text)
    return tagged_scalar(trimmed, bare_number(trimmed))


def bare_number(trimmed: Column) -> Column:
    """Number of trimmed delimited text, else null."""
    bare = F.translate(trimmed, "$,", "")
    return F.when(~trimmed.contains("_"), finite_number(bare))


def tagged_scalar(trimmed: Column, num: Column) -> Column:
    kind = (
        F.when(trimmed.isNull() | (trimmed == ""), "empty")
        .when(num.isNotNull(), "number")
        .otherwise("text")
    )
    return F.struct(
        kind.alias("kind"),
        F.when(trimmed != "", trimmed).alias("text"),
        num.alias("num"),
    )


def plain_number(text: Column) -> Column:
    """Table-cell number: commas dropped, no currency handling."""
    return finite_number(F.regexp_replace(strip(text), ",", ""))


def scaled_number(text: Column) -> Column:
    """Number mention in prose: currency sign and magnitude word applied."""
    bare = F.lower(F.regexp_replace(text, ",", ""))
    bare = F.regexp_replace(bare, "^[£$€]+", "")
    word = F.regexp_extract(bare, r"(thousand|million|billion|bn)$", 1)
    factor = F.lit(1.0)
    for name, value in NUMBER_WORDS.items():
        factor = F.when(word == name, F.lit(float(value))).otherwise(factor)
    digits = F.regexp_replace(bare, r"\s*(thousand|million|billion|bn)$", "")
    return finite_number(digits) * factor


def json_value_type(token: Column) -> Column:
    """Value-type tag of one JSON scalar token."""
    token = F.trim(token)
    return (
        F.when(token.isNull() | (token == "null"), F.lit(None).cast("string"))
        .when(token.isin("true", "false"), "boolean")
        .when(token.rlike(INTEGER_PATTERN), "integer")
        .when(token.rlike(NUMBER_PATTERN), "number")
        .otherwise("string")
    )


def cell_kind(value_type: Column) -> Column:
    """Cell kind tag of a value-type tag; null means an empty cell."""
    return (
        F.when(value_type.isNull(), "empty")
        .when(value_type == "boolean", "boolean")
        .when(value_type.isin("integer", "number", "decimal"), "number")
        .otherwise("text")
    )


def numeric_twin(text: Column, value_type: Column) -> Column:
    """Strict numeric twin: only numeric types have one, booleans do not."""
    return F.when(
        value_type.isin("integer", "number", "decimal"), finite_number(text)
    )


def number_or_null(text: Column) -> Column:
    """Lenient numeric twin of any text, thousands commas allowed."""
    return finite_number(F.regexp_replace(F.trim(text), ",", ""))


def normalize_name(name: Column) -> Column:
    """Column name to snake case."""
    spaced = F.regexp_replace(strip(name), r"([a-z0-9])([A-Z])", "$1_$2")
    joined = F.regexp_replace(spaced, r"[^A-Za-z0-9]+", "_")
    return F.lower(F.regexp_replace(joined, r"^_+|_+$", ""))


def semantic_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "")


def semantic_candidates(name: Column) -> Column:
    """Whole name, then its parts at ``. # / :``, letters and digits only."""
    parts = F.concat(F.array(name), F.split(name, r"[.#/:]"))
    return F.array_distinct(
        F.filter(F.transform(parts, semantic_name), lambda part: part != "")
    )


def concept_leaf(concept: Column) -> Column:
    """Local part of a concept identifier."""
    for separator in ("#", "/", ".", ":"):
        concept = F.substring_index(concept, separator, -1)
    return concept


def humanize(text: Column) -> Column:
    spaced = F.regexp_replace(text, r"[_\-.]+", " ")
    return F.trim(F.regexp_replace(spaced, r"\s+", " "))


def clean_space(text: Column) -> Column:
    """Collapse white space, including the no-break kinds."""
    return F.trim(F.regexp_replace(text, "[\\s\\u00A0\\u202F]+", " "))


def column_letters(number: Column, letters: int = 14) -> Column:
    """Spreadsheet column number to letters (bijective base 26).

    Fourteen letters hold every bigint.
    """

    def add_letter(state: Column, _: Column) -> Column:
        rest, name = state["rest"], state["name"]
        letter = F.char(65 + (rest - 1) % 26)
        return F.when(
            rest > 0,
            F.struct(
                F.call_function("div", rest - 1, F.lit(26)).alias("rest"),
                F.concat(letter, name).alias("name"),
            ),
        ).otherwise(state)

    start = F.struct(number.cast("bigint").alias("rest"), F.lit("").alias("name"))
    steps = F.sequence(F.lit(1), F.lit(letters))
    return F.aggregate(steps, start, add_letter)["name"]


def column_number(letters: Column) -> Column:
    """Spreadsheet column letters to number; null for anything else."""
    value = F.aggregate(
        F.split(F.upper(letters), ""),
        F.lit(0).cast("bigint"),
        lambda total, letter: total * 26 + (F.ascii(letter) - 64),
    )
    return F.when(letters.rlike("^[A-Za-z]+$"), value)


def split_address(address: Column) -> Column:
    """``B12`` to ``struct<column, row>``; null when malformed."""
    shape = r"^([A-Za-z]+)([0-9]+)$"
    return F.when(
        address.rlike(shape),
        F.struct(
            F.upper(F.regexp_extract(address, shape, 1)).alias("column"),
            F.regexp_extract(address, shape, 2).try_cast("bigint").alias("row"),
        ),
    )


def scale_value(num: Column, text: Column, scale: Column) -> Column:
    """``struct<text, num, error>`` of a source value times its scale.

    Text is passed through unscaled when the scale is one and is an error
    otherwise; an empty value is always an error.
    """
    scaled = num * scale
    error = F.when(text.isNull() & num.isNull(), "empty_value").when(
        num.isNull() & (scale != 1), "nonnumeric_value"
    )
    return F.struct(
        F.when(num.isNotNull(), number_text(scaled))
        .when(error.isNull(), text)
        .alias("text"),
        scaled.alias("num"),
        error.alias("error"),
    )


def month_number(name: Column) -> Column:
    pairs = [F.lit(item) for pair in MONTH_NUMBERS.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), name)


def month_period(year: Column, name: Column) -> Column:
    """``2023`` and ``March`` to ``2023-03``; null for an unknown month name."""
    return F.concat(
        year.cast("string"), F.lit("-"), F.lpad(month_number(name).cast("string"), 2, "0")
    )


def month_code(date: Column) -> Column:
    """Month period as one integer, ``YYYYMM``."""
    return (F.year(date) * 100 + F.month(date)).cast("bigint")


def academic_year_end(text: Column) -> Column:
    """``2023-24`` or ``2023/24`` to 2024; null for anything else."""
    shape = r"^([0-9]{4})[-/][0-9]{2}$"
    trimmed = strip(text)
    return F.when(
        trimmed.rlike(shape),
        F.regexp_extract(trimmed, shape, 1).cast("bigint") + 1,
    )


def padded_code(number: Column, width: int, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def geography_code(geography_id: Column) -> Column:
    """Two-digit area code at the end of a ``…US06`` identifier, else null."""
    code = F.regexp_extract(geography_id, "US([0-9]{2})$", 1)
    return F.when(code != "", code)


def dash_slug(text: Column, default: str = "source") -> Column:
    slug = F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-")
    slug = F.regexp_replace(slug, r"^-+|-+$", "")
    return F.when(slug == "", F.lit(default)).otherwise(slug)


def path_slug(text: Column, default: str = "source") -> Column:
    return F.replace(dash_slug(text, default), F.lit("-"), F.lit("_"))


def stable_slug(*parts: Column) -> Column:
    """Path-like slug: blanks to underscores, brackets and commas dropped."""
    cleaned = [
        F.when(
            part != "",
            F.replace(F.regexp_replace(part, "^/+|/+$", ""), F.lit(" "), F.lit("_")),
        )
        for part in parts
    ]
    joined = F.lower(F.concat_ws("/", *cleaned))
    joined = F.replace(joined, F.lit("__"), F.lit("_"))
    return F.regexp_replace(joined, "[(),]", "")


def first_year(text: Column) -> Column:
    """First year token in the text (``fy``/``ty`` prefix allowed), else null."""
    tokens = F.split(F.lower(text), "[^a-z0-9]+")
    shape = "^(fy|ty)?((19|20)[0-9]{2})$"
    years = F.transform(
        F.filter(tokens, lambda token: token.rlike(shape)),
        lambda token: F.regexp_extract(token, shape, 2),
    )
    in_range = F.filter(
        years,
        lambda year: year.cast("int").between(YEAR_FROM, YEAR_TO),
    )
    return F.get(in_range, F.lit(0))


def keyword_class(
    text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str | None = None
) -> Column:
    """First rule whose pattern list matches wins.

    A pattern is a substring, ``^prefix`` or ``=whole text``.
    """

    def matches(pattern: str) -> Column:
        if pattern.startswith("^"):
            return text.startswith(pattern[1:])
        if pattern.startswith("="):
            return text == pattern[1:]
        return text.contains(pattern)

    result = None
    for label, patterns in rules:
        test = matches(patterns[0])
        for pattern in patterns[1:]:
            test = test | matches(pattern)
        result = F.when(test, label) if result is None else result.when(test, label)
    return result.otherwise(F.lit(default))


def rounded_count(text: Column, scale: float = 1.0) -> Column:
    """Money or count text to an integer, halves to even, after scaling."""
    clean = F.trim(F.regexp_replace(text, r"[$,]", ""))
    num = finite_number(clean)
    return F.bround(num * F.lit(float(scale)), 0).cast("bigint")


def loose_equal(left: Column, right: Column) -> Column:
    """Numeric comparison when both sides are numbers, else text comparison."""
    left_num, right_num = number_or_null(left), number_or_null(right)
    return F.when(
        left_num.isNotNull() & right_num.isNotNull(), left_num == right_num
    ).otherwise(left.eqNullSafe(right))


def operator_match(source: Column, operator: Column, expected: Column) -> Column:
    """Does a source value satisfy ``operator expected``?

    Order operators need numbers on both sides and are false otherwise.  The
    ``in`` operator reads ``expected`` as a list separated by ``|``.
    """
    left, right = number_or_null(source), number_or_null(expected)
    ordered = (
        F.when(operator == ">", left > right)
        .when(operator == ">=", left >= right)
        .when(operator == "<", left < right)
        .when(operator == "<=", left <= right)
    )
    return F.coalesce(
        F.when(operator == "==", loose_equal(source, expected))
        .when(operator == "!=", ~loose_equal(source, expected))
        .when(
            operator == "in",
            F.exists(
                F.split(expected, r"\|"), lambda item: loose_equal(source, item)
            ),
        )
        .otherwise(ordered),
        F.lit(False),
    )


def is_source_specific(source_name: Column, variable: Column) -> Column:
    """Does the variable sit in the namespace of its own source?"""
    named = source_name.isNotNull() & (source_name != "")
    return F.coalesce(
        named
        & (
            variable.startswith(F.concat(source_name, F.lit(".")))
            | variable.startswith(F.concat(source_name, F.lit(":")))
        ),
        F.lit(False),
    )


def iso_date(text: Column) -> Column:
    """ISO date text to a date; null when it is not one."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def render_template(text: Column, year: Column) -> Column:
    """Fill ``{year}`` and ``{filing_year}`` placeholders."""
    filled = F.replace(text, F.lit("{filing_year}"), (year + 1).cast("string"))
    return F.replace(filled, F.lit("{year}"), year.cast("string"))


def rendered_number(rendered: Column) -> Column:
    """Integer of a digit string without a leading zero, else null."""
    return F.when(rendered.rlike("^(0|[1-9][0-9]*)$"), rendered.try_cast("bigint"))


def key_part(text: Column) -> Column:
    """One cleaned part of a storage path."""
    return F.regexp_replace(strip(text), "^/+|/+$", "")


def content_path(
    prefix: Column,
    source: Column,
    package: Column,
    year: Column,
    digest: Column,
    filename: Column,
) -> Column:
    """Content-addressed path of a stored file."""
    return F.concat_ws(
        "/",
        key_part(prefix),
        key_part(source),
        key_part(package),
        year.cast("string"),
        digest,
        F.substring_index(filename, "/", -1),
    )
