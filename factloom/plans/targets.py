"""Targets, strata and their loads: star tables built from facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import keys as K
from factloom.operators.sequence import first_wins, join_on

# --- fixed values: shares of returns, income and tax by income bracket --------
BRACKET_SHARES = [
    ("under_1", 0.02, 0.00, 0.00),
    ("1_to_10k", 0.12, 0.01, 0.00),
    ("10k_to_25k", 0.15, 0.03, 0.01),
    ("25k_to_50k", 0.18, 0.08, 0.04),
    ("50k_to_75k", 0.14, 0.10, 0.06),
    ("75k_to_100k", 0.11, 0.10, 0.08),
    ("100k_to_200k", 0.17, 0.22, 0.20),
    ("200k_to_500k", 0.08, 0.18, 0.22),
    ("500k_to_1m", 0.02, 0.10, 0.14),
    ("1m_plus", 0.01, 0.18, 0.25),
]
# --- fixed values: categories of qualifying children --------------------------
CHILD_CATEGORIES = {
    "0_children": ("==", "0"),
    "1_child": ("==", "1"),
    "2_children": ("==", "2"),
    "3plus_children": (">=", "3"),
}
# ------------------------------------------------------------------------------

STEP = "struct<operation:string,parameters:string>"
TERM = "struct<variable:string,operator:string,value:string>"


def term(variable: str, operator: Column | str, value: Column) -> Column:
    """One stratum constraint."""
    op = F.lit(operator) if isinstance(operator, str) else operator
    return F.struct(
        F.lit(variable).alias("variable"), op.alias("operator"), value.alias("value")
    ).cast(TERM)


def at_level(targets: DataFrame, level: str) -> DataFrame:
    """Targets that are active at a geography level."""
    return targets.filter(F.array_contains("geography_levels", level))


def measured_targets(
    facts: DataFrame, measures: Sequence[tuple[str, str, str, str]], level: str
) -> DataFrame:
    """Facts at one level mapped to target variables; other concepts dropped.

    ``measures`` lists (concept, variable, target type, unit).  The map is
    program text, so it becomes a map literal and needs no join.
    """
    entries = []
    for concept, variable, kind, unit in measures:
        entries += [
            F.lit(concept),
            F.struct(
                F.lit(variable).alias("variable"),
                F.lit(kind).alias("target_type"),
                F.lit(unit).alias("target_unit"),
            ),
        ]
    found = F.try_element_at(F.create_map(*entries), F.col("measure.concept"))
    return (
        facts.filter(
            (F.col("geography.level") == level)
            & F.col("measure.concept").isin([m[0] for m in measures])
        )
        .withColumn("_m", found)
        .select("*", "_m.variable", "_m.target_type", "_m.target_unit")
        .drop("_m")
    )


def nested_targets(
    targets: DataFrame, strata: DataFrame, constraints: DataFrame
) -> DataFrame:
    """Targets with their stratum and its list of constraints.

    The constraints of one stratum are its definition, a handful of terms.
    Filters put on the result reach the scans through the joins.
    """
    listed = constraints.groupBy("stratum_id").agg(
        F.array_sort(F.collect_list(F.struct("variable", "operator", "value"))).alias(
            "constraints"
        )
    )
    return targets.join(
        strata.join(listed, "stratum_id", "left"), "stratum_id", "left"
    )


def find_targets(
    targets: DataFrame,
    strata: DataFrame,
    order: Sequence[str],
    limit: int,
    **equal: object,
) -> DataFrame:
    """Targets with their stratum, filtered by equality, first rows in order."""
    test = F.lit(True)
    for name, value in equal.items():
        if value is not None:
            test = test & (F.col(name) == value)
    return targets.filter(test).join(strata, "stratum_id").orderBy(*order).limit(limit)


def insert_if_absent(
    stored: DataFrame, loaded: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Append loaded rows whose key is not stored; first loaded row wins."""
    first = first_wins(loaded, keys, [order])
    fresh = join_on(first, stored.select(*keys), keys, "left_anti")
    return stored.unionByName(fresh)


def get_or_create_strata(
    stored: DataFrame | None, loaded: DataFrame, order: str = "seq"
) -> DataFrame:
    """One stratum per definition hash; stored ones win, then the first loaded.

    The key *is* the hash of the sorted constraints and the jurisdiction, so
    no serial number has to be handed out.
    """
    ranked = loaded.withColumn("_rank", F.lit(1))
    if stored is not None:
        ranked = stored.withColumn("_rank", F.lit(0)).unionByName(ranked)
    hashed = ranked.withColumn(
        "definition_hash", K.stratum_hash(F.col("constraints"), F.col("jurisdiction"))
    )
    return first_wins(hashed, ["definition_hash"], ["_rank", order]).drop("_rank")


def stratum_terms(strata: DataFrame) -> DataFrame:
    """Child table: the constraints of each stratum with their ordinal."""
    return strata.select(
        "definition_hash", F.posexplode("constraints").alias("ordinal", "item")
    ).select("definition_hash", "ordinal", "item.*")


def strata_tree(leaves: DataFrame, levels: Sequence[tuple[str, str]], jurisdiction: str):
    """Nested strata from leaf rows: level k is constrained by k columns.

    ``levels`` lists (column, variable) from the top.  The parent is known by
    its definition hash, so the levels need no join to each other.
    """
    place = F.lit(jurisdiction)
    result, parent = None, F.lit(None).cast("string")
    for depth in range(1, len(levels) + 1):
        chosen = levels[:depth]
        terms = F.array(*[term(var, "==", F.col(c).cast("string")) for c, var in chosen])
        own = K.stratum_hash(terms, place)
        part = (
            leaves.select(*[c for c, _ in chosen])
            .distinct()
            .select(
                F.lit(depth).alias("depth"),
                F.concat_ws(" / ", *[F.col(c) for c, _ in chosen]).alias("name"),
                own.alias("definition_hash"),
                parent.alias("parent_hash"),
                terms.alias("constraints"),
            )
        )
        result = part if result is None else result.unionByName(part)
        parent = own
    return result


def registry_drift(declared: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Entries declared but not present (missing) or the reverse (unmapped)."""
    left = declared.select(key).distinct().withColumn("_d", F.lit(True))
    right = present.select(key).distinct().withColumn("_p", F.lit(True))
    return (
        left.join(right, key, "full_outer")
        .filter(F.col("_d").isNull() | F.col("_p").isNull())
        .select(
            key,
            F.when(F.col("_d").isNull(), "unmapped").otherwise("missing").alias("drift"),
        )
    )


def missing_coverage(entries: DataFrame, role: str, registry: DataFrame) -> DataFrame:
    """Aliases required by entries of a role that the registry lacks."""
    required = (
        entries.filter(F.col("role") == role)
        .select(F.explode("aliases").alias("alias"))
        .distinct()
    )
    return required.join(registry, "alias", "left_anti")


def fallback_lookup(
    items: DataFrame, lookups: Sequence[tuple[str, DataFrame, str, str]], value: str
) -> DataFrame:
    """First lookup that knows the item wins.

    A lookup is ``(basis, table, item key, table key)``; the table also holds
    ``value`` and has one row per key.
    """
    joined, found, basis = items, [], None
    for index, (name, known, item_key, known_key) in enumerate(lookups):
        column = f"_v{index}"
        side = known.select(
            F.col(known_key).alias(f"_k{index}"), F.col(value).alias(column)
        )
        joined = joined.join(
            side, F.col(item_key) == F.col(f"_k{index}"), "left"
        ).drop(f"_k{index}")
        found.append(column)
        test = F.col(column).isNotNull()
        basis = F.when(test, name) if basis is None else basis.when(test, name)
    return joined.withColumns({value: F.coalesce(*found), "basis": basis}).drop(*found)


def step(operation: str, parameters: Mapping[str, Column | None]) -> Column:
    """One derivation step; its parameters as ``name=value`` text."""
    texts = [
        F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("None")))
        for name, value in parameters.items()
        if value is not None
    ]
    return F.struct(
        F.lit(operation).alias("operation"),
        F.concat_ws(", ", *texts).alias("parameters"),
    ).cast(STEP)


def no_steps() -> Column:
    return F.array().cast(f"array<{STEP}>")


def scale_facts(
    facts: DataFrame,
    factor: float,
    unit: str | None = None,
    operation: str = "scale_value",
    note: str | None = None,
) -> DataFrame:
    """Scale the value, set the unit and append the derivation step."""
    new_unit = F.col("unit") if unit is None else F.lit(unit)
    applied = step(
        operation,
        {
            "factor": F.lit(factor),
            "input_unit": F.col("unit"),
            "output_unit": new_unit,
            "note": None if note is None else F.lit(note),
        },
    )
    return facts.withColumns(
        {
            "value": F.col("value") * F.lit(factor),
            "steps": F.concat("steps", F.array(applied)),
            "unit": new_unit,
        }
    )


def convert_units(facts: DataFrame, factor: float, to_unit: str) -> DataFrame:
    return scale_facts(facts, factor, to_unit, "convert_units")


def apply_shares(
    totals: DataFrame, shares: DataFrame, keys: Sequence[str], whole: bool = False
) -> DataFrame:
    """Published total times published share of the same source.

    ``whole`` cuts the fraction off, as counts need.
    """
    applied = step(
        "apply_share",
        {
            "share": F.col("share"),
            "share_name": F.col("share_name"),
            "total_fact": F.col("name"),
        },
    )
    value = F.col("value") * F.col("share")
    joined = totals.join(shares, list(keys))
    return joined.withColumns(
        {
            "steps": F.concat("steps", F.array(applied)),
            "value": value.cast("bigint").cast("double") if whole else value,
        }
    )


def format_steps(steps: Column) -> Column:
    texts = F.transform(
        steps,
        lambda item: F.when(
            item["parameters"] != "",
            F.concat(item["operation"], F.lit("("), item["parameters"], F.lit(")")),
        ).otherwise(item["operation"]),
    )
    return F.array_join(texts, "; ")


def as_targets(facts: DataFrame, target_type: str, level: str | None = None) -> DataFrame:
    """Target rows from facts; defaults come from the fact itself."""
    derived = F.when(
        F.size("steps") > 0,
        F.concat(F.lit("Derived via: "), format_steps(F.col("steps")), F.lit(".")),
    )
    text = F.concat_ws(" ", F.nullif("notes", F.lit("")), derived)
    notes = F.nullif(text, F.lit(""))
    return facts.select(
        "stratum_hash",
        F.coalesce("variable", "name").alias("variable"),
        "period",
        "value",
        F.lit(target_type).alias("target_type"),
        F.lit(level).cast("string").alias("geographic_level"),
        "source",
        notes.alias("notes"),
        F.coalesce("is_preliminary", F.lit(False)).alias("is_preliminary"),
    )


def allocate_brackets(totals: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Totals over the fixed brackets; each product is cut to a whole number.

    The ten brackets are program text: each total row is exploded in place.
    """
    brackets = F.array(
        *[
            F.struct(
                F.lit(name).alias("bracket"),
                (F.col("total_returns") * F.lit(returns)).cast("bigint").alias("returns"),
                (F.col("total_income") * F.lit(income)).cast("bigint").alias("income"),
                (F.col("total_tax") * F.lit(tax)).cast("bigint").alias("tax"),
            )
            for name, returns, income, tax in BRACKET_SHARES
        ]
    )
    return totals.select(*keep, F.inline(brackets))


def load_targets(
    wide: DataFrame,
    measures: Sequence[tuple[str, str, str]],
    constraints: Column,
    jurisdiction: Column,
    period: str,
) -> DataFrame:
    """Wide rows to long target rows, one per stated measure.

    ``measures`` lists (column, variable, target type); a null measure is
    optional and skipped.  One job serves every publisher table.
    """
    items = F.array(
        *[
            F.struct(
                F.lit(variable).alias("variable"),
                F.lit(kind).alias("target_type"),
                F.col(column).cast("double").alias("value"),
            )
            for column, variable, kind in measures
        ]
    )
    stated = F.filter(items, lambda item: item["value"].isNotNull())
    return wide.select(
        K.stratum_hash(constraints, jurisdiction).alias("stratum_hash"),
        F.col(period).cast("bigint").alias("period"),
        F.inline(stated),
    )


def category_terms(category: Column, variable: str) -> Column:
    """Constraint of a child-count category; null for an unknown category."""
    entries = [
        part
        for name, (operator, value) in CHILD_CATEGORIES.items()
        for part in (F.lit(name), term(variable, operator, F.lit(value)))
    ]
    return F.try_element_at(F.create_map(*entries), category)
