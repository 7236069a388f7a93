"""Records that cross lines and splits: quoted delimited files, JSON array files.

A file is read in splits, cut into pieces at a mark (a line break, a comma).  What
a piece means depends on the state before it (inside quotes or not, how deep), so
each piece is taken as a function of that state.  Such functions compose in any
grouping: pieces are composed inside their split, splits are composed over one
row each, and no task reads more than its splits.  Everything runs in SQL
functions; a broken record or item becomes an issue row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factloom.functions.scalars import bare_number, bound, strip, tagged_scalar
from factloom.operators.sequence import join_on
from factloom.session import store

BLOCK = ["file", "start"]
#: Characters of the longest record or item; a longer one is an issue row.
LONGEST = 16 * 2**20


def split_pieces(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """``file, start, place, piece``: text between marks, numbered from 1 per split."""
    pieces = spark.read.text(path, lineSep=mark).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("piece"),
    )
    place = F.row_number().over(W.partitionBy(*BLOCK).orderBy("_id"))
    first = (F.col("start") == 0) & (F.col("place") == 1)
    return pieces.withColumn("place", place.cast("bigint")).select(
        *BLOCK,
        "place",
        F.when(first, F.regexp_replace("piece", "^﻿", "")).otherwise(F.col("piece")).alias("piece"),
    )


def with_state(
    rows: DataFrame, group: Sequence[str], order: str, if_0: Column, if_1: Column
) -> DataFrame:
    """States of a machine with the states 0 and 1, composed within ``group``.

    ``if_0`` and ``if_1``: whether a row leaves the state 1 if it was 0 or 1
    before.  Adds ``before`` and ``after``, the states around each row if the
    group starts in 0, and ``before_fixed`` and ``after_fixed``: whether they are
    the same if it starts in 1 (else they are the other ones).
    """
    so_far = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    row_before = W.partitionBy(*group).orderBy(order)
    marked = rows.withColumns({"_0": if_0.cast("int"), "_1": if_1.cast("int")}).withColumn(
        "_swaps", F.sum(F.when((F.col("_0") == 1) & (F.col("_1") == 0), 1).otherwise(0)).over(so_far)
    )
    # The last row that forgets the state before it decides, up to the swaps after it.
    base = F.last(
        F.when(F.col("_0") == F.col("_1"), F.col("_0").bitwiseXOR((F.col("_swaps") % 2).cast("int"))),
        ignorenulls=True,
    ).over(so_far)
    after = F.coalesce("_base", F.lit(0)).bitwiseXOR((F.col("_swaps") % 2).cast("int"))
    return (
        marked.withColumn("_base", base)
        .withColumns({"after": after, "after_fixed": F.col("_base").isNotNull()})
        .withColumns(
            {
                "before": F.lag("after", 1, 0).over(row_before),
                "before_fixed": F.lag("after_fixed", 1, False).over(row_before),
            }
        )
        .drop("_0", "_1", "_swaps", "_base")
    )


def _given(state: str, start: Column) -> Column:
    """``state`` if its group starts in ``start``."""
    return F.when(F.col(f"{state}_fixed"), F.col(state)).otherwise(F.col(state).bitwiseXOR(start))


def _splits(pieces: DataFrame, totals: Sequence[str]) -> DataFrame:
    """Per split its state at its start and the ``totals`` of earlier splits.

    ``totals``: names of running sums that come as a pair, ``name_0`` and
    ``name_1``, for a split that starts in 0 or 1.
    """
    pairs = [f"{name}_{i}" for name in totals for i in (0, 1)]
    kept = ["after", "after_fixed", *pairs]
    last = pieces.groupBy(*BLOCK).agg(F.max_by(F.struct(*kept), "place").alias("_last"))
    last = last.select(*BLOCK, *[F.col(f"_last.{c}").alias(c) for c in kept])
    # One row per split of a file from here on.
    chained = with_state(
        last.drop("before"),
        ["file"],
        "start",
        F.col("after") == 1,
        F.when(F.col("after_fixed"), F.col("after") == 1).otherwise(F.col("after") == 0),
    )
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    own = lambda name: F.when(F.col("before") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))
    return chained.select(
        *BLOCK,
        F.col("before").alias("_in"),
        *[F.coalesce(F.sum(own(n)).over(earlier), F.lit(0)).alias(f"_{n}") for n in totals],
    )


def _joined_pieces(
    pieces: DataFrame, unit: str, mark: str, longest: int
) -> tuple[DataFrame, DataFrame]:
    """Pieces of one ``unit`` per row, put together with ``mark`` between them, and
    the units that are longer than ``longest``, which are left out."""
    key = ["file", unit]
    sizes = pieces.groupBy(*key).agg(F.sum(F.char_length("piece") + 1).alias("n_chars"))
    long = sizes.filter(F.col("n_chars") > longest + 1)
    fitting = pieces.join(long, key, "left_anti")
    parts = F.array_sort(F.collect_list(F.struct(*["start", "place", "piece"])))
    whole = fitting.groupBy(*key).agg(
        F.array_join(F.transform(parts, lambda p: p["piece"]), mark).alias("text"),
        F.max_by("after", F.struct("start", "place")).alias("open"),
    )
    return whole, long


# --- delimited -------------------------------------------------------------------
def _field(delimiter: str) -> str:
    """One field behind a delimiter; the quotes of a quoted one are kept."""
    mark = re.escape(delimiter)
    return rf'(?s){mark}("(?:[^"]++|"")*+"?[^{mark}]*+|[^{mark}]*+)'


def fields(text: Column, delimiter: str = ",") -> Column:
    """Array of the fields of a record, unquoted.

    Only a field that begins with a quote is quoted; what follows its closing
    quote belongs to it as it stands.
    """
    raw = F.regexp_extract_all(F.concat(F.lit(delimiter), text), F.lit(_field(delimiter)), F.lit(1))
    body = r'(?s)^"((?:[^"]++|"")*+)"?(.*)$'

    def unquoted(field: Column) -> Column:
        inner = F.replace(F.regexp_extract(field, body, 1), F.lit('""'), F.lit('"'))
        return F.when(field.startswith('"'), F.concat(inner, F.regexp_extract(field, body, 2))).otherwise(field)

    return F.transform(raw, unquoted)


def delimited_records(
    spark: SparkSession, path: str, delimiter: str = ",", longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """``file, record, text`` of delimited files, records from 1, and issue rows.

    A record ends at a line break outside quotes; breaks inside stay in its text.
    A record longer than ``longest`` characters is an issue instead of a row, a
    record whose quote is open at the end of the file is both.
    """
    mark = re.escape(delimiter)
    closed = rf'(?:"(?:[^"]++|"")*+"[^{mark}]*+|[^"{mark}][^{mark}]*+|)'
    leaves_open = rf'(?s)\A(?:{closed}{mark})*+"(?:[^"]++|"")*+\z'
    piece = F.col("piece")
    lines = with_state(
        split_pieces(spark, path, "\n"),
        BLOCK,
        "place",
        piece.contains('"') & piece.rlike(leaves_open),
        # A line that starts inside quotes goes on with an opened field.
        ~piece.contains('"') | F.concat(F.lit('"x'), piece).rlike(leaves_open),
    )
    so_far = W.partitionBy(*BLOCK).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    begins = lambda start: F.sum((_given("before", F.lit(start)) == 0).cast("bigint")).over(so_far)
    lines = store(lines.withColumns({"begun_0": begins(0), "begun_1": begins(1)}), "lines")
    placed = join_on(lines, _splits(lines, ["begun"]), BLOCK, "inner").select(
        *BLOCK,
        "place",
        "piece",
        (F.col("_begun") + F.when(F.col("_in") == 0, F.col("begun_0")).otherwise(F.col("begun_1"))).alias("record"),
        _given("before", F.col("_in")).alias("before"),
        _given("after", F.col("_in")).alias("after"),
    )
    alone = (F.col("before") == 0) & (F.col("after") == 0)
    whole, long = _joined_pieces(placed.filter(~alone), "record", "\n", longest)
    short = F.char_length("piece") <= longest
    single = placed.filter(alone & short).select("file", "record", F.col("piece").alias("text"), "after")
    records = single.unionByName(whole.withColumnRenamed("open", "after"))
    issues = (
        long.select("file", "record")
        .unionByName(placed.filter(alone & ~short).select("file", "record"))
        .withColumn("code", F.lit("record_too_long"))
        .unionByName(whole.filter("open = 1").select("file", "record", F.lit("quote_left_open").alias("code")))
    )
    ended = F.regexp_replace("text", r"\r\z", "")
    return records.select("file", "record", ended.alias("text")), issues


def delimited_rows(
    spark: SparkSession, path: str, delimiter: str = ",", longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """``file, row_number, values`` of delimited files, and their issue rows.

    ``values``: ``array<struct<pos, name, kind, text, num>>`` in the order of the
    file's own header.  The header is record 1, so rows count from 2.  Outer
    blanks and a leading ``%`` of a name are dropped; of repeated names the last
    counts.  Short records are padded, surplus fields ignored, and a blank
    record is a row of empty values.  All files are parsed in one pass: a record
    meets its file's header by a join.
    """
    records, issues = delimited_records(spark, path, delimiter, longest)
    names = F.transform(
        fields(F.col("text"), delimiter), lambda n: F.regexp_replace(strip(n), "^%", "")
    )
    # Pairs of a position and a name; a name's last position is kept.
    slots = F.filter(
        F.transform("_names", lambda n, i: F.struct((i + 1).alias("pos"), n.alias("name"))),
        lambda s: s["pos"] == F.size("_names") + 1 - F.array_position(F.reverse("_names"), s["name"]),
    )
    headers = (
        records.filter("record = 1")
        .select("file", names.alias("_names"))
        .select("file", slots.alias("_slots"))
    )
    typed = F.transform(
        F.transform(fields(F.col("text"), delimiter), strip),
        lambda t: F.struct(t.alias("text"), bare_number(t).alias("num")),
    )
    rows = join_on(records.filter("record > 1"), headers, ["file"], "inner").select(
        "file", F.col("record").alias("row_number"), "_slots", typed.alias("_typed")
    )

    def value(slot: Column, typed: Column) -> Column:
        found = F.get(typed, slot["pos"] - 1)
        scalar = tagged_scalar(found["text"], found["num"])
        return F.struct(
            slot["pos"].alias("pos"),
            slot["name"].alias("name"),
            *[scalar[c].alias(c) for c in ("kind", "text", "num")],
        )

    values = bound(F.col("_typed"), lambda t: F.transform("_slots", lambda s: value(s, t)))
    return rows.select("file", "row_number", values.alias("values")), issues


# --- JSON ------------------------------------------------------------------------
def _bare(piece: Column, state: Column) -> Column:
    """``piece`` without strings; ``state`` 1: it starts inside a string."""
    outside = F.when(state == 1, F.regexp_replace(piece, r'(?s)\A[^"]*("|\z)', "")).otherwise(piece)
    return F.regexp_replace(outside, r'(?s)"[^"]*("|\z)', "")


def _deeper(bare: Column) -> Column:
    size = lambda marks: F.char_length(bare) - F.char_length(F.translate(bare, marks, ""))
    return (size("[{") - size("]}")).cast("bigint")


def json_items(
    spark: SparkSession, path: str, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """``file, kind, item, text``: what lies one level deep in JSON files, and issues.

    ``kind`` is ``array``, ``object`` or ``value`` by the file's first character;
    the items of an object are its ``"name": value`` pairs, a value is one item.
    Files are cut at their commas, so a file of one line is read by many tasks.
    A file that ends inside a string or a bracket is an issue, ``longest`` as in
    ``delimited_records``.
    """
    escaped = F.regexp_replace("piece", r"(?s)\\.", "")
    odd = (F.char_length("_plain") - F.char_length(F.translate("_plain", '"', ""))) % 2 == 1
    pieces = split_pieces(spark, path, ",").withColumn("_plain", escaped)
    pieces = with_state(pieces, BLOCK, "place", odd, ~odd)
    so_far = W.partitionBy(*BLOCK).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    deep = lambda start: F.sum(
        _deeper(_bare(F.col("_plain"), _given("before", F.lit(start))))
    ).over(so_far)
    pieces = store(
        pieces.withColumns({"deep_0": deep(0), "deep_1": deep(1)}).drop("_plain"), "pieces"
    )
    placed = join_on(pieces, _splits(pieces, ["deep"]), BLOCK, "inner").select(
        *BLOCK,
        "place",
        "piece",
        _given("after", F.col("_in")).alias("after"),
        (F.col("_deep") + F.when(F.col("_in") == 0, F.col("deep_0")).otherwise(F.col("deep_1"))).alias("depth"),
    )
    # A comma one level deep and outside strings ends an item.
    cut = ((F.col("after") == 0) & (F.col("depth") == 1)).cast("bigint")
    earlier = W.partitionBy(*BLOCK).orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    counted = placed.withColumn("_cuts", F.coalesce(F.sum(cut).over(earlier), F.lit(0)))
    totals = placed.groupBy(*BLOCK).agg(F.sum(cut).alias("_n"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(*BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = join_on(counted, starts, BLOCK, "inner").withColumn(
        "item", F.col("_before") + F.col("_cuts") + 1
    )
    numbered = store(numbered.select(*BLOCK, "place", "piece", "after", "depth", "item"), "numbered")
    first = F.min_by(F.ltrim(F.regexp_replace("piece", r"\A\s+", "")), F.struct("start", "place"))
    ends = numbered.groupBy("file").agg(
        F.substring(first, 1, 1).alias("_first"),
        F.max("item").alias("_last"),
        F.max_by(F.struct("after", "depth"), F.struct("start", "place")).alias("_end"),
    )
    kind = F.when(F.col("_first") == "[", "array").when(F.col("_first") == "{", "object").otherwise("value")
    whole, long = _joined_pieces(numbered, "item", ",", longest)
    text = F.col("text")
    outer = F.col("kind") != "value"
    text = F.when(outer & (F.col("item") == 1), F.regexp_replace(text, r"\A\s*[\[{]", "")).otherwise(text)
    tail = outer & (F.col("item") == F.col("_last")) & (F.col("_end.depth") == 0)
    text = F.when(tail, F.regexp_replace(text, r"[\]}]\s*\z", "")).otherwise(text)
    items = join_on(whole, ends.withColumn("kind", kind), ["file"], "inner").select(
        "file", "kind", "item", "_last", text.alias("text")
    )
    # An empty array or object has no item.
    items = items.filter(~((F.col("_last") == 1) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")))
    broken = ends.filter("_end.after <> 0 or _end.depth <> 0").select(
        "file", F.lit(None).cast("bigint").alias("item"), F.lit("json_left_open").alias("code")
    )
    issues = long.select("file", "item", F.lit("item_too_long").alias("code")).unionByName(broken)
    # Names, rows and issues are read from the items, which are put together once.
    return store(items.drop("_last"), "items"), issues


def _value(item: Column) -> Column:
    """``struct<kind, text, num>`` of a variant; text is typed like delimited text."""

    def typed(read: Column) -> Column:
        is_text = read["kind"] == "STRING"
        number = read["kind"].rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        text = F.when(is_text, strip(read["text"])).otherwise(read["text"])
        num = lambda t: F.when(number, t.try_cast("double")).when(is_text, bare_number(t))
        return bound(
            bound(text, lambda t: F.struct(t.alias("text"), num(t).alias("num"), read["kind"].alias("kind"))),
            named,
        )

    def named(v: Column) -> Column:
        name = (
            F.when(v["text"].isNull() | (v["text"] == ""), "empty")
            .when(v["kind"] == "BOOLEAN", "flag")
            .when(v["num"].isNotNull(), "number")
            .otherwise("text")
        )
        text = F.when(v["text"] != "", v["text"])
        return F.struct(name.alias("kind"), text.alias("text"), v["num"].alias("num"))

    read = lambda v: F.struct(
        F.schema_of_variant(v).alias("kind"), F.try_variant_get(v, "$", "string").alias("text")
    )
    return bound(bound(item, read), typed)


def table_values(
    items: DataFrame, keep: Sequence[str], every_name: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``table_rows`` with a row's ``values`` as an array of structs.

    ``every_name``: the names of a table of objects are those of all its objects,
    in the order in which they are first met.
    """
    parsed = items.select(*keep, "item", F.try_parse_json("text").alias("_v"), "text")
    form = F.regexp_extract(F.schema_of_variant("_v"), "^(ARRAY|OBJECT)", 1)
    parsed = parsed.withColumn("_form", form)
    listed = F.try_variant_get("_v", "$", "array<string>")
    names = F.when(F.col("_form") == "ARRAY", listed).otherwise(F.json_object_keys("text"))
    clean = lambda n: F.regexp_replace(strip(F.coalesce(n, F.lit("None"))), "^%", "")
    # (position, name as in an item, cleaned name), the last of equal names only.
    slots = F.filter(
        F.transform(
            "_names",
            lambda n, i: F.struct((i + 1).alias("pos"), n.alias("key"), clean(n).alias("name")),
        ),
        lambda s: s["pos"]
        == F.size("_names") + 1 - F.array_position(F.reverse(F.transform("_names", clean)), s["name"]),
    )
    heads = parsed.filter("item = 1").select(*keep, F.col("_form").alias("_head"), names.alias("_names"))
    if every_name:
        keys = parsed.filter("_form = 'OBJECT'").select(
            *keep, "item", F.posexplode(F.json_object_keys("text")).alias("_at", "_key")
        )
        met_at = keys.groupBy(*keep, "_key").agg(F.min(F.struct("item", "_at")).alias("_met"))
        every = met_at.groupBy(*keep).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_met", "_key"))), lambda k: k["_key"]
            ).alias("_every")
        )
        heads = join_on(heads, every, keep, "left").withColumn(
            "_names", F.when(F.col("_head") == "OBJECT", F.col("_every")).otherwise(F.col("_names"))
        )
    met = join_on(parsed, heads.select(*keep, "_head", slots.alias("_slots")), keep, "left")
    fine = (F.col("_form") == F.col("_head")) & (F.col("_head") != "")
    code = (
        F.when(F.col("_v").isNull(), "not_json")
        .when((F.col("item") == 1) & (F.col("_form") == ""), "table_shape")
        .otherwise("row_shape")
    )
    issues = met.filter(~F.coalesce(fine, F.lit(False))).select(*keep, "item", code.alias("code"))
    body = met.filter(fine & ~((F.col("_head") == "ARRAY") & (F.col("item") == 1))).select(
        *keep,
        F.col("item").alias("row_number"),
        F.try_variant_get("_v", "$", "array<variant>").alias("_l"),
        F.try_variant_get("_v", "$", "map<string,variant>").alias("_m"),
        "_slots",
    )

    def value(slot: Column, row: Column) -> Column:
        found = F.coalesce(F.get(row["l"], slot["pos"] - 1), F.try_element_at(row["m"], slot["key"]))
        return F.struct(slot["pos"].alias("position"), slot["name"].alias("name"), _value(found).alias("_s"))

    plain = lambda v: F.struct(
        v["position"].alias("position"),
        v["name"].alias("name"),
        *[v["_s"][c].alias(c) for c in ("kind", "text", "num")],
    )
    row = F.struct(F.col("_l").alias("l"), F.col("_m").alias("m"))
    values = bound(row, lambda r: F.transform(F.transform("_slots", lambda s: value(s, r)), plain))
    return body.select(*keep, "row_number", values.alias("values")), issues


def table_rows(items: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON tables and issue rows, from ``keep``, ``item`` and ``text``.

    ``item`` counts the items of one document from 1, ``text`` is the JSON of one
    item.  The first item gives the form.  An array is a header of names: rows
    are the arrays after it, counted from 2.  An object gives its names in its
    own order: rows are the objects, counted from 1, and other names are
    ignored.  Outer blanks and a leading ``%`` of a name are dropped; of
    repeated names the last counts.  An item of another form is a ``row_shape``
    issue and one that is no JSON is ``not_json``; the other items stay.
    Rows: ``row_number, position, name, kind, text, num``; kind is ``empty``,
    ``flag``, ``number`` or ``text``.
    """
    rows, issues = table_values(items, keep)
    return rows.select(*keep, "row_number", F.inline("values")), issues


def json_documents(
    docs: DataFrame, keep: Sequence[str], text: str
) -> tuple[DataFrame, DataFrame]:
    """``table_rows`` of documents in a column; a document that is no JSON array is
    one issue with a null item."""
    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    opened = docs.select(*keep, items.alias("_items"), F.get_json_object(text, "$[0]").alias("_one"))
    parts = opened.select(*keep, "_one", F.posexplode("_items").alias("_at", "_v")).select(
        *keep,
        (F.col("_at") + 1).cast("bigint").alias("item"),
        # The first item's own text keeps the order of its names.
        F.when((F.col("_at") == 0) & F.schema_of_variant("_v").startswith("OBJECT"), F.col("_one"))
        .otherwise(F.to_json("_v"))
        .alias("text"),
    )
    rows, issues = table_rows(parts, keep)
    broken = opened.filter(F.col("_items").isNull()).select(
        *keep, F.lit(None).cast("bigint").alias("item"), F.lit("not_json").alias("code")
    )
    return rows, issues.unionByName(broken)


def landed_json(spark: SparkSession, path: str, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``file, row_number, values_json`` of JSON files, and their issue rows.

    An array of arrays lands its rows after the header under the header's names,
    an array of objects its objects under the names of all of them.  An object
    lands one row per key: ``key`` with the members of its value if that is an
    object, else ``key`` and ``value`` as JSON.  Any other value is one row
    ``value``.  Payloads hold text; a missing value is null.
    """
    items, issues = json_items(spark, path, longest)
    pair = F.try_parse_json(F.concat(F.lit("{"), "text", F.lit("}")))
    entry = F.get(F.map_entries(F.try_variant_get(pair, "$", "map<string,variant>")), F.lit(0))
    members = F.try_variant_get("_e.value", "$", "map<string,string>")
    keyed = lambda more: F.to_json(F.map_concat(F.create_map(F.lit("key"), F.col("_e.key")), more))
    # A member called "key" would stand in the key's place; the key stays.
    rest = F.map_filter(members, lambda k, _: k != "key")
    whole = F.create_map(F.lit("value"), F.to_json("_e.value"))
    by_key = F.when(F.schema_of_variant("_e.value").startswith("OBJECT"), keyed(rest)).otherwise(keyed(whole))
    single = F.to_json(F.create_map(F.lit("value"), F.trim("text")))
    text = (
        F.when(F.col("kind") == "array", F.col("text"))
        .when(F.col("kind") == "value", single)
        .when(F.col("_e").isNull(), F.col("text"))
        .otherwise(by_key)
    )
    tables = items.withColumn("_e", entry).select("file", "item", text.alias("text"))
    rows, more = table_values(tables, ["file"], every_name=True)
    entries = F.map_from_entries(F.transform("values", lambda v: F.struct(v["name"], v["text"])))
    heads = tables.filter("item = 1").select(
        "file", F.ltrim(F.regexp_replace("text", r"\A\s+", "")).startswith("[").cast("int").alias("_skip")
    )
    landed = join_on(rows, heads, ["file"], "left").select(
        "file",
        (F.col("row_number") - F.coalesce("_skip", F.lit(0))).alias("row_number"),
        F.to_json(entries).alias("values_json"),
    )
    return landed, issues.unionByName(more)
