"""Counts, duplicates and set reports over facts, rows and cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.sequence import first_wins, join_on, number_rows


def counts_by(rows: DataFrame, dims: Mapping[str, Column]) -> DataFrame:
    """Counts along many dimensions in one pass: ``dim, key, n``.

    Null keys are dropped.  Each row is exploded to one (dim, key) pair per
    dimension, combined on the map side, so a dominant key is no burden.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dim"), key.cast("string").alias("key"))
            for name, key in dims.items()
        ]
    )
    return (
        rows.select(F.inline(pairs))
        .filter(F.col("key").isNotNull())
        .groupBy("dim", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_common(counts: DataFrame) -> DataFrame:
    """Rank of each key in its dimension, most frequent first, ties by key.

    Keys are sorted into range partitions and numbered by partition, so a
    dimension with many keys is no one's burden.
    """
    ordered = counts.withColumns({"_less": -F.col("n"), "_row": F.lit(0).cast("bigint")})
    ranked = number_rows(ordered, ["dim"], "_row", "rank", lead=["_less", "key"])
    return ranked.drop("_less", "_row")


def missing_counts(rows: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    return rows.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def distinct_counts(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact number of distinct values of each column, one row.

    Values are de-duplicated per (column, value) first, so no distinct set is
    ever held in one task.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("dim"), F.col(n).cast("string").alias("key"))
            for n in names
        ]
    )
    return (
        rows.select(F.inline(pairs))
        .filter(F.col("key").isNotNull())
        .distinct()
        .groupBy("dim")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_members(rows: DataFrame, key: str, members: Mapping[str, Column]):
    """Distinct members of duplicated keys in long form: key, kind, member.

    The long form keeps a key shared by a third of the rows in many rows
    instead of one huge list.
    """
    repeated = duplicate_keys(rows, key).drop("n")
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("kind"), value.cast("string").alias("member"))
            for name, value in members.items()
        ]
    )
    return (
        join_on(rows, repeated, [key], "inner")
        .select(key, F.inline(pairs))
        .filter(F.col("member").isNotNull())
        .distinct()
    )


def duplicate_positions(rows: DataFrame, key: str, position: str) -> DataFrame:
    """Each position of a duplicated key with the first position of that key."""
    repeated = (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first_position"))
        .filter("n > 1")
    )
    return rows.select(key, position).join(repeated, key)


def cell_counts(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    return cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.col("kind") != "empty").alias("nonempty"),
    )


def row_counts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def lineage_coverage(records: DataFrame) -> DataFrame:
    """Records resolved, records with lineage, and their ratio (0 when none)."""
    resolved = F.count_if("resolved")
    lineaged = F.count_if(F.col("resolved") & (F.col("lineage_count") > 0))
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        resolved.alias("resolved"),
        lineaged.alias("lineaged"),
    ).withColumn(
        "lineage_ratio",
        F.when(F.col("resolved") > 0, F.col("lineaged") / F.col("resolved")).otherwise(0.0),
    )


def side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row reports with different columns, put into one row."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(name).alias(name) for name in rows.columns])


def store_stats(
    targets: DataFrame, strata: DataFrame, source: str, period: str
) -> DataFrame:
    """Sizes of the store and its distinct sources and periods, one row."""
    sizes = targets.agg(
        F.count(F.lit(1)).alias("targets"),
        F.count_distinct(source).alias("sources"),
        F.count_distinct(period).alias("periods"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
    )
    return side_by_side([sizes, strata.agg(F.count(F.lit(1)).alias("strata"))])


def source_summary(targets: DataFrame, projection_from: int = 2024) -> DataFrame:
    """Per source: count, variables, years and whether it is a projection.

    The set of years of a source is small: at most one entry per year.
    """
    return targets.groupBy("source").agg(
        F.count(F.lit(1)).alias("count"),
        F.count_distinct("variable").alias("variables"),
        F.min("period").alias("year_min"),
        F.max("period").alias("year_max"),
        F.sort_array(F.collect_set("period")).alias("years"),
        (F.min("period") >= projection_from).alias("is_projection"),
    )


def group_sources(targets: DataFrame, by: Column, name: str) -> DataFrame:
    """Per year or area: count and the sorted distinct sources."""
    return targets.groupBy(by.alias(name)).agg(
        F.count(F.lit(1)).alias("count"),
        F.sort_array(F.collect_set("source")).alias("sources"),
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, n`` for each table."""
    result = None
    for name, frame in tables.items():
        part = frame.agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


def multiset_shortfall(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Expected items that occur less often in ``actual``."""
    want = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    have = actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("present"))
    return (
        join_on(want, have, keys)
        .withColumn("present", F.coalesce("present", F.lit(0)))
        .filter("present < expected")
    )


def distinct_alignments(facts: DataFrame) -> DataFrame:
    """Distinct concept alignments; the first fact of each wins."""
    stated = facts.filter(
        (F.col("measure.source_concept") != "")
        & (F.col("measure.concept_relation") != "")
    ).select(
        "seq",
        F.col("measure.source_concept").alias("source_concept"),
        F.col("measure.concept").alias("canonical_concept"),
        F.col("measure.concept_relation").alias("relation"),
        F.col("measure.legal_vintage").alias("legal_vintage"),
        F.col("measure.concept_evidence_url").alias("evidence_url"),
        F.col("measure.concept_evidence_notes").alias("evidence_notes"),
        "source_record_id",
    )
    keys = ["source_concept", "canonical_concept", "relation", "legal_vintage"]
    return first_wins(stated, keys, ["seq"])


def bundle_union(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Union of the rows of many packages, tagged with their package."""
    result = None
    for name, frame in parts.items():
        tagged = frame.withColumn("package", F.lit(name))
        result = (
            tagged
            if result is None
            else result.unionByName(tagged, allowMissingColumns=True)
        )
    return result


def key_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each distinct key with the side it is found on."""
    sides = (
        left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(key)
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    )
    side = F.when((F.col("_l") == 1) & (F.col("_r") == 1), "both").otherwise(
        F.when(F.col("_l") == 1, "left").otherwise("right")
    )
    return sides.select(key, side.alias("side"))


# --- fixed values: errors that mean "no data for this year" --------------------
UNAVAILABLE_CODES = ["record_set_compile_failed", "source_artifact_unavailable"]
# ------------------------------------------------------------------------------


def availability(packages: DataFrame, errors: DataFrame, year: int) -> DataFrame:
    """Split packages into those to build and those skipped for the year.

    A package is skipped when it has errors and all of them say that the year
    is not available.
    """
    messages = [f"'{year}'", f"No source artifact for year {year}"]
    unavailable = F.col("code").isin(UNAVAILABLE_CODES) & F.col("message").isin(messages)
    state = errors.groupBy("package").agg(F.every(unavailable).alias("_skip"))
    return packages.join(state, "package", "left").select(
        *packages.columns,
        F.when(F.col("_skip"), "skipped").otherwise("build").alias("state"),
        F.when(
            F.col("_skip"), "source package is not available for requested year"
        ).alias("reason"),
    )
