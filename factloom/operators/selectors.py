"""Selectors: rows by criteria, cells by address, ranges, guards, regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.sequence import join_on, number_rows

BLOCK = 1024
#: Rectangles of a block that meet its cells in one part.
ROOM = 4096

#: Tables of cells are made of narrow, well packed columns: the optimizer, which goes by
#: the size of the files, would broadcast a side of a hundred times that in memory.
MERGED = "merge"


def selector_text(value: Column) -> Column:
    """Selector comparison form: original text, null as the empty text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def select_exactly_one(
    selectors: DataFrame,
    rows: DataFrame,
    signatures: Sequence[Sequence[str]],
    row_id: str,
) -> DataFrame:
    """Match each selector to rows; exactly one match is expected.

    ``selectors`` holds ``selector_id`` and ``criteria`` (map of column to
    text).  Selectors are split by the set of columns they use, and each set
    is one equi-join.  Rows are counted per criteria value *before* the join,
    so a value shared by a third of the rows arrives as one row.
    """
    result = None
    for names in signatures:
        wanted = F.array_sort(F.map_keys("criteria")) == F.array(
            *[F.lit(name) for name in sorted(names)]
        )
        keys = [f"_k_{name}" for name in names]
        texts = [selector_text(F.col(name)).alias(k) for name, k in zip(names, keys)]
        indexed = rows.select(row_id, *texts).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("match_count"), F.min(row_id).alias(row_id)
        )
        asked = selectors.filter(wanted).select(
            "selector_id",
            *[F.col("criteria")[name].alias(k) for name, k in zip(names, keys)],
        )
        part = asked.join(indexed, keys, "left").drop(*keys)
        result = part if result is None else result.unionByName(part)
    count = F.coalesce("match_count", F.lit(0).cast("bigint"))
    return result.select(
        "selector_id",
        count.alias("match_count"),
        F.when(count == 1, F.col(row_id)).alias(row_id),
        F.when(count != 1, "selector_not_unique").alias("issue"),
    )


def select_first(
    selectors: DataFrame, rows: DataFrame, names: Sequence[str], ordinal: str
) -> DataFrame:
    """Earliest matching row per selector; unmatched selectors vanish.

    ``selectors`` holds ``selector_no`` and the columns ``names`` (text).
    Survivors are renumbered densely from 2 in selector order.
    """
    keys = [f"_k_{name}" for name in names]
    texts = [selector_text(F.col(name)).alias(k) for name, k in zip(names, keys)]
    earliest = rows.select(ordinal, *texts).groupBy(*keys).agg(F.min(ordinal).alias(ordinal))
    asked = selectors.select(
        "selector_no", *[F.col(name).alias(k) for name, k in zip(names, keys)]
    )
    found = asked.join(earliest, keys).drop(*keys)
    return number_rows(found, [], "selector_no", "grid_row", start=2)


def lookup_cells(
    specs: DataFrame, cells: DataFrame, keys: Sequence[str], expected_kind: str
) -> DataFrame:
    """Cell at each address, with an issue when missing or of another kind."""
    found = cells.withColumn("_hit", F.lit(True)).hint(MERGED)
    joined = join_on(specs, found, keys)
    kind = F.col("kind")
    issue = F.when(F.col("_hit").isNull(), "selector_did_not_match").when(
        F.col(expected_kind).isNotNull() & (F.col(expected_kind) != kind),
        "unexpected_cell_kind",
    )
    return joined.withColumn("issue", issue).drop("_hit")


def sum_row_ranges(
    ranges: DataFrame, cells: DataFrame, keys: Sequence[str], row: str = "row"
) -> DataFrame:
    """Sum of the numeric cells of a row range in one column.

    ``ranges`` holds ``range_id``, the key columns, ``row_from`` and
    ``row_to``.  Every row must exist and be numeric; otherwise the value is
    null and the issue says why.  Ranges are exploded to single rows, so the
    lookup is an exact equi-join whatever the length of the range.
    """
    asked = ranges.filter("row_to >= row_from").withColumn(
        row, F.explode(F.sequence("row_from", "row_to"))
    )
    joined = join_on(asked, cells.withColumn("_hit", F.lit(1)), [*keys, row])
    expected = F.max(F.col("row_to") - F.col("row_from") + 1)
    totals = joined.groupBy("range_id").agg(
        F.sum("_hit").alias("_found"),
        F.count("value_num").alias("_numeric"),
        expected.alias("_expected"),
        F.sum(F.col("value_num").cast("double")).alias("_total"),
    )
    checked = ranges.select("range_id", "row_from", "row_to").join(
        totals, "range_id", "left"
    )
    issue = (
        F.when(F.col("row_to") < F.col("row_from"), "inverted_range")
        .when(~F.col("_found").eqNullSafe(F.col("_expected")), "missing_cell")
        .when(F.col("_numeric") != F.col("_expected"), "nonnumeric_cell")
    )
    return checked.select(
        "range_id",
        issue.alias("issue"),
        F.when(issue.isNull(), F.col("_total")).alias("value"),
    )


def check_guards(guards: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Guard rows with their outcome.

    ``guards`` holds ``record_id``, ``guard``, the address keys, and the
    expected ``expected_type`` and ``expected_text``/``expected_num``.  A null
    expectation is skipped.  Numbers compare as numbers; a boolean never
    equals a number.
    """
    asked = guards.filter(F.col("expected_type").isNotNull())
    joined = join_on(asked, cells.withColumn("_hit", F.lit(True)).hint(MERGED), keys)
    numeric = ["integer", "number", "decimal"]
    same = F.when(
        F.col("expected_type").isin(numeric),
        F.col("value_type").isin(numeric) & (F.col("value_num") == F.col("expected_num")),
    ).otherwise(
        (F.col("value_type") == F.col("expected_type"))
        & (F.col("value_text") == F.col("expected_text"))
    )
    issue = F.when(F.col("_hit").isNull(), "missing_guard_cell").when(
        ~F.coalesce(same, F.lit(False)), "guard_mismatch"
    )
    return joined.withColumn("issue", issue).drop("_hit")


def check_range_labels(labels: DataFrame, cells: DataFrame) -> DataFrame:
    """Label columns beside row ranges: one row per label cell, with its outcome.

    ``labels`` holds ``record_id``, ``guard``, ``column``, ``row_from``, ``row_to``
    and ``expected``, an array of ``struct<type, text, num>`` with one label per row
    of the range.  A range without an end, with more or fewer labels than rows or
    with a null label is one issue row without ``row``; its cells are not read.
    """
    rows = F.col("row_to") - F.col("row_from") + 1
    fault = (
        F.when(F.col("row_to").isNull(), "no_end_address")
        .when(F.coalesce(F.size("expected"), F.lit(0)) != rows, "label_count")
        .when(F.exists("expected", lambda label: label["type"].isNull()), "null_label")
    )
    marked = labels.withColumn("issue", fault)
    guards = marked.filter(F.col("issue").isNull()).select(
        "record_id", "guard", "column", "row_from", F.posexplode("expected").alias("_at", "_label")
    )
    guards = guards.select(
        "record_id",
        "guard",
        (F.col("row_from") + F.col("_at")).alias("row"),
        "column",
        F.col("_label.type").alias("expected_type"),
        F.col("_label.text").alias("expected_text"),
        F.col("_label.num").alias("expected_num"),
    )
    names = ["record_id", "guard", "row", "column", "issue"]
    faults = marked.filter(F.col("issue").isNotNull()).withColumn(
        "row", F.lit(None).cast("bigint")
    )
    return check_guards(guards, cells, ["row", "column"]).select(names).unionByName(
        faults.select(names)
    )


def guard_report(checked: DataFrame) -> DataFrame:
    """Per record: number of guards, and whether all of them hold."""
    return checked.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("guard_count"),
        F.count("issue").alias("issue_count"),
        F.every(F.col("issue").isNull()).alias("ok"),
    )


def lineage_keys(parts: DataFrame) -> DataFrame:
    """Ordered distinct lineage keys per record, in long form.

    ``parts`` holds ``record_id``, ``ordinal`` and ``cell_key``; a key keeps
    its first position.  The ordinal is dense from 1.  A record has a handful
    of lineage cells unless it sums a long range, so numbering is by blocks.
    """
    first = parts.groupBy("record_id", "cell_key").agg(F.min("ordinal").alias("ordinal"))
    return number_rows(first, ["record_id"], "ordinal", "position").drop("ordinal")


def covering_regions(
    cells: DataFrame,
    regions: DataFrame,
    row: Column,
    column: Column,
    sheet: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """Pairs of cells and the rectangles that hold them.

    A rectangle is exploded to the row blocks it touches and joined on the
    block, so the plan is an equi-join for any number of rectangles; each cell
    has one block, hence no pair appears twice.  The rectangles of a block are dealt
    into parts of about ``ROOM``, and the cells of the block meet every part, so many
    rectangles in one place are many tasks' work.
    """
    tall = regions.filter("bottom_row >= top_row").withColumn(
        "_block",
        F.explode(
            F.sequence(
                F.floor(F.col("top_row") / block), F.floor(F.col("bottom_row") / block)
            )
        ),
    )
    placed = cells.withColumns(
        {"_row": row, "_column": column, "_block": F.floor(row / block)}
    )
    keys = [*sheet, "_block"]
    # One row per block that has rectangles.
    parts = tall.groupBy(*keys).agg((F.count(F.lit(1)) / ROOM).cast("long").alias("_parts"))
    dealt = F.pmod(F.xxhash64(*tall.columns), F.col("_parts") + 1).alias("_part")
    tall = tall.join(parts, keys).select(*tall.columns, dealt)
    placed = placed.join(parts, keys).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), "_parts"))
    )
    return (
        placed.join(tall.hint(MERGED), [*keys, "_part"])
        .filter(
            F.col("_row").between(F.col("top_row"), F.col("bottom_row"))
            & F.col("_column").between(F.col("left_column"), F.col("right_column"))
        )
        .drop("_row", "_column", "_block", "_part", "_parts")
    )


def region_report(
    regions: DataFrame, pairs: DataFrame, cell_id: Sequence[str]
) -> DataFrame:
    """Distinct covered cells per region, with the issue of the region."""
    covered = pairs.groupBy("region_id").agg(
        F.count_distinct(*cell_id).alias("covered_cells")
    )
    copies = regions.groupBy("region_id").agg(F.count(F.lit(1)).alias("_copies"))
    bad = (
        (F.col("top_row") < 1)
        | (F.col("left_column") < 1)
        | (F.col("bottom_row") < F.col("top_row"))
        | (F.col("right_column") < F.col("left_column"))
    )
    count = F.coalesce("covered_cells", F.lit(0).cast("bigint"))
    return (
        regions.join(copies, "region_id")
        .join(covered, "region_id", "left")
        .select(
            "region_id",
            count.alias("covered_cells"),
            F.when(F.trim("region_id") == "", "missing_region_id")
            .when(bad, "malformed_region_bounds")
            .when(F.col("_copies") > 1, "duplicate_region_id")
            .when(count == 0, "region_matches_no_cells")
            .alias("issue"),
        )
    )


def find_column(
    cells: DataFrame, sheet: Sequence[str], phrases: Sequence[str], depth: int = 8
) -> DataFrame:
    """First column whose first rows, joined, contain all the phrases.

    At most ``depth`` cells per column are gathered.
    """
    header = F.lower(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("row", "label"))),
                lambda item: item["label"],
            ),
            " ",
        )
    )
    headers = (
        cells.filter((F.col("row") <= depth) & (F.col("label") != ""))
        .groupBy(*sheet, "column")
        .agg(header.alias("header"))
    )
    test = F.lit(True)
    for phrase in phrases:
        test = test & F.col("header").contains(phrase.lower())
    return headers.filter(test).groupBy(*sheet).agg(F.min("column").alias("column"))


def first_by_label(
    labels: DataFrame, rows: DataFrame, label: Column, ordinal: str, value: Column
) -> DataFrame:
    """Value of the first row with each cleaned label; missing is an issue."""
    first = (
        rows.select(label.alias("label"), F.col(ordinal).alias("_o"), value.alias("_v"))
        .groupBy("label")
        .agg(F.min_by(F.struct("_o", "_v"), "_o").alias("_first"))
    )
    return labels.join(first, "label", "left").select(
        *labels.columns,
        F.col("_first._o").alias("row_number"),
        F.col("_first._v").alias("value"),
        F.when(F.col("_first").isNull(), "missing_label").alias("issue"),
    )


def resolve_lineage(
    facts: DataFrame, fact_id: str, keys: str, resolved: DataFrame, key: str
) -> DataFrame:
    """Facts with no lineage keys and facts whose keys do not all resolve."""
    missing = facts.filter(F.size(keys) == 0).select(
        fact_id, F.lit("missing_lineage").alias("issue"), F.lit(0).cast("bigint").alias("unresolved")
    )
    asked = facts.select(fact_id, F.explode(keys).alias(key))
    unresolved = (
        asked.join(resolved.select(key), key, "left_anti")
        .groupBy(fact_id)
        .agg(F.count(F.lit(1)).alias("unresolved"))
        .select(fact_id, F.lit("unresolved_lineage").alias("issue"), "unresolved")
    )
    return missing.unionByName(unresolved)


def dangling_references(
    edges: Sequence[tuple[str, DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """Dangling references per declared edge, as one report.

    An edge is ``(name, child, child key, parent, parent key)``.
    """
    report = None
    for name, child, child_key, parent, parent_key in edges:
        keys = child.groupBy(F.col(child_key).alias("_k")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        known = parent.select(F.col(parent_key).alias("_k")).distinct()
        part = (
            keys.filter(F.col("_k").isNotNull())
            .join(known, "_k", "left_anti")
            .agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("dangling_rows"),
                F.count(F.lit(1)).alias("dangling_keys"),
            )
            .withColumn("edge", F.lit(name))
        )
        report = part if report is None else report.unionByName(part)
    return report.select("edge", "dangling_rows", "dangling_keys")
