"""Delimited, JSON and plain-text scans, and JSON-lines sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.functions.scalars import bare_number, strip, tagged_scalar
from factloom.operators.sequence import join_on
from factloom.sources.records import delimited_rows, landed_json

LINE_BREAK = "\\r\\n|[\\n\\r\\u000B\\u000C\\u001C-\\u001E\\u0085\\u2028\\u2029]"


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_number, line`` of text files of any size.

    Files are split for reading.  Lines are numbered inside each split (a
    bounded block of bytes) and shifted by the line counts of earlier splits.
    """
    block = ["file", "start"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    counts = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    local = lines.withColumn(
        "_local", F.row_number().over(W.partitionBy(*block).orderBy("_id")).cast("bigint")
    )
    return join_on(local, offsets, block).select(
        "file", (F.col("_o") + F.col("_local")).alias("line_number"), "line"
    )


def header_names(header_line: str, delimiter: str = ",") -> list[str]:
    """Header cells: byte-order mark, outer blanks and a leading ``%`` dropped."""
    import csv

    cells = next(csv.reader([header_line.removeprefix("﻿")], delimiter=delimiter))
    return [cell.strip().removeprefix("%") for cell in cells]


def parse_delimited(
    lines: DataFrame, keep: Sequence[str], names: Sequence[str], delimiter: str = ","
) -> DataFrame:
    """Lines to ``values array<struct<pos, name, kind, text, num>>``.

    Short rows are padded with nulls and surplus fields are ignored.  Where a
    header name is repeated only its last column is kept.
    """
    mark = re.escape(delimiter)
    field = rf'{mark}("(?:[^"]++|"")*+"[^{mark}]*|[^{mark}]*)'
    quoted = r'(?s)^"((?:[^"]++|"")*+)"(.*)$'

    def unquote(text: Column) -> Column:
        inner = F.replace(F.regexp_extract(text, quoted, 1), F.lit('""'), F.lit('"'))
        plain = F.concat(inner, F.regexp_extract(text, quoted, 2))
        return F.when(text.startswith('"'), plain).otherwise(text)

    # A leading delimiter gives every field the same shape.
    raw = F.regexp_extract_all(F.concat(F.lit(delimiter), "line"), F.lit(field), F.lit(1))
    last = {name: i for i, name in enumerate(names)}
    used = [(i, name) for i, name in enumerate(names) if last[name] == i]
    # Staged, so that each text is trimmed and each number is read once.
    parsed = (
        lines.withColumn("_row", F.transform(raw, unquote))
        .withColumns({f"_t{i}": strip(F.get("_row", F.lit(i))) for i, _ in used})
        .withColumns({f"_n{i}": bare_number(F.col(f"_t{i}")) for i, _ in used})
    )

    def value(i: int, name: str) -> Column:
        scalar = tagged_scalar(F.col(f"_t{i}"), F.col(f"_n{i}"))
        return F.struct(
            F.lit(i + 1).alias("pos"),
            F.lit(name).alias("name"),
            scalar["kind"].alias("kind"),
            scalar["text"].alias("text"),
            scalar["num"].alias("num"),
        )

    values = F.array(*[value(i, name) for i, name in used])
    return parsed.select(*keep, values.alias("values"))


def read_delimited(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Rows of delimited files; ``records.delimited_rows`` has their issues too."""
    return delimited_rows(spark, path, delimiter)[0]


def json_object_rows(docs: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """Array of objects: columns of the first object, ordinals from 1."""
    items = F.from_json(text, "array<map<string,string>>")
    first = docs.select(*keep, items.alias("_items")).withColumn(
        "_names", F.map_keys(F.get("_items", F.lit(0)))
    )
    return first.select(
        *keep, "_names", F.posexplode("_items").alias("_pos", "_item")
    ).select(
        *keep,
        (F.col("_pos") + 1).cast("bigint").alias("row_number"),
        F.posexplode("_names").alias("pos", "name"),
        "_item",
    ).select(
        *keep,
        "row_number",
        (F.col("pos") + 1).alias("position"),
        "name",
        F.try_element_at("_item", F.col("name")).alias("value"),
    )


def json_array_rows(docs: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """Array of arrays: header first, ordinals from 2."""
    items = F.from_json(text, "array<array<string>>")
    parsed = docs.select(*keep, items.alias("_items")).withColumn(
        "_names", F.get("_items", F.lit(0))
    )
    return (
        parsed.select(*keep, "_names", F.posexplode("_items").alias("_pos", "_item"))
        .filter("_pos > 0")
        .select(
            *keep,
            (F.col("_pos") + 1).cast("bigint").alias("row_number"),
            F.posexplode("_names").alias("_p", "name"),
            "_item",
        )
        .select(
            *keep,
            "row_number",
            (F.col("_p") + 1).alias("position"),
            "name",
            F.get("_item", F.col("_p")).alias("value"),
        )
    )


def to_json_lines(rows: DataFrame) -> DataFrame:
    """One JSON text per row, fields in sorted order, nulls dropped."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("value"))


def write_json_lines(rows: DataFrame, path: str) -> None:
    to_json_lines(rows).write.mode("overwrite").text(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Blank lines are skipped; a line that is not valid JSON is an error."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def bad_json_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not a JSON object, with their line number."""
    parsed = F.try_parse_json("line")
    stated = F.trim("line") != ""
    return lines.filter(
        stated & (parsed.isNull() | (F.schema_of_variant(parsed).startswith("OBJECT") == F.lit(False)))
    )


def text_lines(docs: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    """``line_number, line`` of each document; no line after a final break."""
    parts = F.split(text, LINE_BREAK)
    last_empty = F.element_at(parts, -1) == ""
    lines = F.when(last_empty, F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return docs.select(*keep, F.posexplode(lines).alias("_pos", "line")).select(
        *keep, (F.col("_pos") + 1).cast("bigint").alias("line_number"), "line"
    )


def landed_rows(rows: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows as JSON payloads of text values, the landing form of any table."""
    payload = F.to_json(F.struct(*[F.col(n).cast("string").alias(n) for n in columns]))
    return rows.select(*keep, payload.alias("values_json"))


def land_file(spark: SparkSession, path: str) -> DataFrame:
    """Suffix-dispatched landing: ``row_number, values_json`` of one file path."""
    lower = path.lower()
    if lower.endswith((".csv", ".csv.gz", ".tsv")):
        rows = read_delimited(spark, path, "\t" if lower.endswith(".tsv") else ",")
        entries = F.map_from_entries(
            F.transform("values", lambda v: F.struct(v["name"], v["text"]))
        )
        # Payload rows are numbered from 1; the header is not one of them.
        return rows.select(
            "file",
            (F.col("row_number") - 1).alias("row_number"),
            F.to_json(entries).alias("values_json"),
        )
    if lower.endswith(".json"):
        return landed_json(spark, path)[0]
    lines = file_lines(spark, path)
    return lines.select(
        "file",
        F.col("line_number").alias("row_number"),
        F.to_json(F.struct("line_number", "line")).alias("values_json"),
    )
