"""Reshaping: rows to values, wide to long, spanning headers, grids, specs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import keys as K
from factloom.functions.scalars import cell_kind, column_letters, normalize_name
from factloom.operators.sequence import join_on, number_rows, running_sum


def melt(rows: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per (row, column): position, names and the value triple.

    A narrow explode of an array of structs: no shuffle and one pass.
    """
    types = dict(rows.dtypes)

    def value_type(name: str) -> str:
        kind = types[name]
        if kind == "boolean":
            return "boolean"
        if kind in ("tinyint", "smallint", "int", "bigint"):
            return "integer"
        if kind.startswith("decimal"):
            return "decimal"
        return "number" if kind in ("double", "float") else "string"

    def triple(position: int, name: str) -> Column:
        text, kind = F.col(name).cast("string"), value_type(name)
        number = kind in ("integer", "number", "decimal")
        return F.struct(
            F.lit(position).cast("bigint").alias("position"),
            F.lit(name).alias("raw_name"),
            F.when(F.col(name).isNotNull(), kind).alias("value_type"),
            text.alias("value_text"),
            (F.col(name) if number else F.lit(None)).cast("double").alias("value_num"),
        )

    cells = F.array(*[triple(i, name) for i, name in enumerate(columns, 1)])
    return (
        rows.select(*keep, F.inline(cells))
        .withColumn("column_name", normalize_name(F.col("raw_name")))
        .withColumn("kind", cell_kind(F.col("value_type")))
    )


def column_catalogue(values: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """Distinct columns per sheet, by position."""
    return values.groupBy(*sheet, "position").agg(
        F.min("raw_name").alias("raw_name"), F.min("column_name").alias("column_name")
    )


def unpivot_labels(
    rows: DataFrame, keep: Sequence[str], labels: Sequence[tuple[str, str]]
) -> DataFrame:
    """Each row once per listed variable; a missing variable gives null."""
    present = set(rows.columns)
    items = F.array(
        *[
            F.struct(
                F.lit(code).alias("source_column_id"),
                F.lit(label).alias("label"),
                (F.col(code) if code in present else F.lit(None))
                .cast("double")
                .alias("value"),
            )
            for code, label in labels
        ]
    )
    return rows.select(*keep, F.inline(items))


def tagged_union(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Union of tables with the tag and the rank of the part they come from."""
    result = None
    for rank, (tag, frame) in enumerate(parts, 1):
        tagged = frame.withColumns(
            {"frequency": F.lit(tag), "part_rank": F.lit(rank).cast("bigint")}
        )
        result = tagged if result is None else result.unionByName(tagged)
    return result


def expand_spans(headers: DataFrame, group: Sequence[str], ordinal: str, span: str):
    """A header of span k covers the next k column positions (from 1)."""
    offset = running_sum(headers, group, ordinal, F.col(span), "_offset")
    covered = F.when(F.col(span) > 0, F.sequence(F.lit(1), F.col(span).cast("bigint")))
    return (
        offset.withColumn("_step", F.explode(covered))
        .withColumn("column_position", F.col("_offset") + F.col("_step"))
        .drop("_offset", "_step")
    )


def span_mismatch(
    headers: DataFrame, columns: DataFrame, group: Sequence[str], span: str
) -> DataFrame:
    """Groups whose header spans do not add up to their column count."""
    spans = headers.groupBy(*group).agg(F.sum(span).alias("span_total"))
    counts = columns.groupBy(*group).agg(F.count(F.lit(1)).alias("column_count"))
    return join_on(spans, counts, group).filter(
        ~F.col("span_total").eqNullSafe(F.coalesce("column_count", F.lit(0)))
    )


def year_columns(
    values: DataFrame, keys: Sequence[str], years: Sequence[int]
) -> DataFrame:
    """Long to wide: one column per listed year, null where absent."""
    wide = [
        F.max(F.when(F.col("year") == year, F.col("value"))).alias(f"value_{year}")
        for year in years
    ]
    return values.groupBy(*keys).agg(*wide)


def integer_range(
    start: Column, end: Column, final: Column | None = None, extra: Column | None = None
) -> Column:
    """Texts of ``start..end``; the last may be replaced, extras appended."""
    values = F.transform(F.sequence(start, end), lambda item: item.cast("string"))
    if final is not None:
        head = F.slice(values, F.lit(1), F.size(values) - 1)
        values = F.when(final.isNotNull(), F.concat(head, F.array(final))).otherwise(
            values
        )
    return values if extra is None else F.concat(values, extra)


def row_grid(
    rows: DataFrame,
    sheet: Sequence[str],
    row_number: str,
    columns: Sequence[str],
    artifact: str,
) -> DataFrame:
    """Rows to cells: header is row 1, rows renumbered densely from 2."""
    numbered = number_rows(rows, sheet, row_number, "grid_row", start=2)
    numbered = numbered.withColumn(
        "source_row_key",
        K.row_key(F.col(artifact), F.lit("rows"), F.col(row_number)),
    )
    body = melt(
        numbered, [*sheet, "grid_row", row_number, "source_row_key"], columns
    ).select(
        *sheet,
        "grid_row",
        F.col("position").alias("grid_column"),
        "kind",
        F.col("value_text").alias("raw"),
        "value_num",
        F.concat(F.lit("source_line_number="), F.col(row_number)).alias("note"),
        "source_row_key",
    )
    names = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("grid_column"), F.lit(name).alias("raw")
            )
            for i, name in enumerate(columns, 1)
        ]
    )
    header = (
        rows.select(*sheet)
        .distinct()
        .select(*sheet, F.lit(1).cast("bigint").alias("grid_row"), F.inline(names))
        .withColumn("kind", F.lit("text"))
    )
    cells = body.unionByName(header, allowMissingColumns=True)
    return cells.withColumn(
        "address",
        F.concat(column_letters(F.col("grid_column")), F.col("grid_row").cast("string")),
    )


def drop_empty(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop all-null rows, then the columns that are null in every row.

    One aggregation row with a count per column reaches the driver.
    """
    kept = rows.dropna("all", subset=list(columns))
    counts = kept.agg(*[F.count(name).alias(name) for name in columns]).first()
    empty = [name for name in columns if counts[name] == 0]
    return kept.drop(*empty)


def json_entries(rows: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """JSON object to one row per key; nested values stay JSON text."""
    return rows.select(
        *keep,
        F.explode(F.from_json(text, "map<string,string>")).alias("key", "value"),
    )


def _override(base: Column, later: Column) -> Column:
    kept = F.map_filter(base, lambda key, _: ~F.map_contains_key(later, key))
    return F.map_concat(kept, later)


def merge_maps(*maps: Column) -> Column:
    """Map union in which later maps win."""
    result = maps[0]
    for later in maps[1:]:
        result = _override(result, later)
    return result


def expand_spec(
    sets: DataFrame, rows: DataFrame, measures: DataFrame, salt: int = 16
) -> DataFrame:
    """Record-set specs: every row of a set with every measure of the set.

    The product is the definition of the result.  Measures of a set are few;
    they are repeated ``salt`` times so that the rows of one large set spread
    over ``salt`` tasks.
    """
    salted_rows = rows.withColumn(
        "_salt", F.pmod(F.xxhash64("value_id", "row_ordinal"), F.lit(salt)).cast("int")
    )
    salted_measures = measures.join(sets, "set_id").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
    )
    pairs = salted_rows.join(salted_measures, ["set_id", "_salt"]).drop("_salt")
    column = F.coalesce("row_column", "measure_column")
    record = F.concat_ws(".", "id_prefix", "value_id", "measure_id")
    return pairs.withColumns(
        {
            "source_record_id": record,
            "column": column,
            "address": F.concat(column, F.col("row_number").cast("string")),
            "end_address": F.concat(column, F.col("row_end_number").cast("string")),
            "filters": merge_maps(
                F.col("shared_filters"), F.col("row_filters"), F.col("measure_filters")
            ),
            "constraints": F.concat(
                "shared_constraints", "row_constraints", "measure_constraints"
            ),
            "scale": F.col("measure_scale") * F.col("row_scale"),
            "geography_id": F.coalesce("row_geography_id", "set_geography_id"),
            "expected_row_header": F.coalesce("row_header", "row_label"),
        }
    )


def spec_regions(specs: DataFrame, column_number: Mapping[str, Column]) -> DataFrame:
    """Bounding rectangle of each record set; column 1 is always inside."""
    low, high = column_number["low"], column_number["high"]
    return specs.groupBy("set_id").agg(
        F.min("row_number").alias("top_row"),
        F.least(F.lit(1).cast("bigint"), F.min(low)).alias("left_column"),
        F.max(F.greatest("row_number", F.coalesce("row_end_number", "row_number")))
        .alias("bottom_row"),
        F.greatest(F.lit(1).cast("bigint"), F.max(high)).alias("right_column"),
    )
