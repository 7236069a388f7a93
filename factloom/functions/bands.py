"""Age and income bands: labels and codes to half-open numeric ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.scalars import number_or_null, strip

# --- fixed values: income-size codes (label, lower, upper) -------------------
INCOME_CODES = [
    (0, "all", None, None),
    (1, "under_1", None, 1),
    (2, "1_to_10k", 1, 10_000),
    (3, "10k_to_25k", 10_000, 25_000),
    (4, "25k_to_50k", 25_000, 50_000),
    (5, "50k_to_75k", 50_000, 75_000),
    (6, "75k_to_100k", 75_000, 100_000),
    (7, "100k_to_200k", 100_000, 200_000),
    (8, "200k_to_500k", 200_000, 500_000),
    (9, "500k_to_1m", 500_000, 1_000_000),
    (10, "1m_plus", 1_000_000, None),
]
# --- fixed values: header codes that stand for a number of children ----------
CHILD_COUNT_CODES = {
    "N59661": 0,
    "A59661": 0,
    "N59662": 1,
    "A59662": 1,
    "N59663": 2,
    "A59663": 2,
    "N59664": 3,
    "A59664": 3,
}
# ----------------------------------------------------------------------------

BAND = "struct<lo:bigint,hi:bigint>"


def _band(lo: Column, hi: Column | None) -> Column:
    upper = F.lit(None) if hi is None else hi
    return F.struct(
        lo.cast("bigint").alias("lo"), upper.cast("bigint").alias("hi")
    ).cast(BAND)


#: Grammar of an age label: who, the first age, then one of four endings.
AGE_LABEL = (
    r"(?i)\b(aged?|female)\s+([0-9]+)"
    r"(?:\s*(?:[-–]|to)\s*([0-9]+)\b"  # a span
    r"|\s+and\s+([0-9]+)\s+years?\b"  # two single years
    r"|(\s+years?)\b"  # one year
    r"|(\s+and\s+over)\b)"  # open; not said of women alone
)
SINGLE_AGE = r"^([0-9]+)(?:\.0+)?$"


def age_band(label: Column) -> Column:
    """Age label to ``struct<lo, hi>``, upper bound exclusive, null = open."""
    text = strip(label)
    said = lambda group: F.nullif(F.regexp_extract(text, AGE_LABEL, group), F.lit(""))
    bare = F.nullif(F.regexp_extract(text, SINGLE_AGE, 1), F.lit("")).try_cast("bigint")
    low = F.coalesce(bare, said(2).try_cast("bigint"))
    last = F.coalesce(said(3), said(4)).try_cast("bigint")
    is_open = bare.isNull() & said(6).isNotNull()
    fits = low.isNotNull() & ~(is_open & (F.lower(said(1)) == "female"))
    high = F.when(~is_open, F.coalesce(F.when(bare.isNull(), last), low) + 1)
    return F.when(fits, _band(low, high))


def age_code_band(code: Column) -> Column:
    """Header code such as ``POP_7`` to a one-year band; 85 is open ended."""
    shape = r"(?i)^POP_([0-9]+)$"
    lower = F.regexp_extract(strip(code), shape, 1).try_cast("bigint")
    return F.when(
        strip(code).rlike(shape),
        F.when(lower == 85, _band(lower, None)).otherwise(_band(lower, lower + 1)),
    )


_AMOUNT = r"([0-9]+(?:\.[0-9]+)?)([km]?)"
#: Grammar of an income label; each amount is two groups, digits and unit.
INCOME_LABEL = rf"^(?:(all)|under_{_AMOUNT}|{_AMOUNT}_plus|{_AMOUNT}_to_{_AMOUNT})$"


def income_bounds(label: Column) -> Column:
    """Income-range label to ``struct<lo, hi>``; null when not a range label."""
    text = F.lower(F.trim(label))

    def amount(group: int) -> Column:
        unit = F.regexp_extract(text, INCOME_LABEL, group + 1)
        factor = F.when(unit == "k", 1e3).when(unit == "m", 1e6).otherwise(1.0)
        digits = F.nullif(F.regexp_extract(text, INCOME_LABEL, group), F.lit(""))
        return digits.try_cast("double") * factor

    bounds = F.struct(
        F.coalesce(amount(4), amount(6)).alias("lo"),
        F.coalesce(amount(2), amount(8)).alias("hi"),
    )
    return F.when(text.rlike(INCOME_LABEL), bounds)


def band_contains(outer: Column, inner: Column) -> Column:
    """Is ``inner`` inside ``outer``?  A null bound of ``outer`` is open."""
    lower = outer["lo"].isNull() | (inner["lo"] >= outer["lo"])
    upper = outer["hi"].isNull() | (inner["hi"] <= outer["hi"])
    return F.coalesce(
        outer.isNotNull() & inner.isNotNull() & lower & upper, F.lit(False)
    )


def income_code_band(code: Column) -> Column:
    """Income-size code to ``struct<label, lo, hi>``; null for other codes."""
    entries = []
    for value, label, lo, hi in INCOME_CODES:
        entries += [
            F.lit(value).cast("bigint"),
            F.struct(
                F.lit(label).alias("label"),
                F.lit(lo).cast("double").alias("lo"),
                F.lit(hi).cast("double").alias("hi"),
            ),
        ]
    number = number_or_null(code).cast("bigint")
    return F.try_element_at(F.create_map(*entries), number)


def child_count(code: Column) -> Column:
    """Number of children behind a header code, else null."""
    pairs = [F.lit(item) for pair in CHILD_COUNT_CODES.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), F.upper(strip(code)))


def adjacent_bands(bands: Column) -> Column:
    """Do distinct bands, sorted by lower bound, join without gap or overlap?

    ``bands`` is ``array<struct<lo, hi>>``.  An open band must be the last one.
    """
    ordered = F.array_sort(F.array_distinct(bands))
    count = F.size(ordered)
    pairs = F.zip_with(
        F.slice(ordered, F.lit(1), F.greatest(count - 1, F.lit(0))),
        F.slice(ordered, F.lit(2), F.greatest(count - 1, F.lit(0))),
        lambda left, right: F.coalesce(left["hi"] == right["lo"], F.lit(False)),
    )
    return (count > 0) & F.forall(pairs, lambda ok: ok)


def bands_match(bands: Column, operator: Column, expected: Column) -> Column:
    """Do adjacent bands, taken together, equal the bound ``operator expected``?"""
    ordered = F.array_sort(F.array_distinct(bands))
    lower = F.get(ordered, F.lit(0))["lo"].cast("double")
    upper = F.try_element_at(ordered, F.lit(-1))["hi"].cast("double")
    number = number_or_null(expected)
    test = (
        F.when(operator == ">=", lower == number)
        .when(operator == ">", lower > number)
        .when(operator == "<", upper == number)
        .when(operator == "<=", (upper - 1) <= number)
    )
    return adjacent_bands(bands) & F.coalesce(test, F.lit(False))
