"""Resolve targets against facts under a strict period rule.

A target names facts by a selector (some of thirteen keys; an absent key
matches anything).  The facts of its exact requested period are taken, else
those of the newest period not after it, else those of the newest period when
only one period type exists.  A period other than the requested one needs a
declared alignment; without one the target is a violation.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import canonical as C
from factloom.functions import keys as K
from factloom.functions.scalars import INTEGER_PATTERN
from factloom.plans.targets import at_level
from factloom.session import store

# --- fixed values -------------------------------------------------------------
SELECTOR_KEYS = [
    "assertion",
    "concept",
    "dimensions",
    "domain",
    "entity",
    "groupby_dimension",
    "provenance_class",
    "record_set_id",
    "record_set_spec_id",
    "source_concept",
    "source_measure_id",
    "source_name",
    "source_table",
]
# ------------------------------------------------------------------------------
PERIOD = ["period_type", "period_value", "period_int"]


def name_set(names: Column) -> Column:
    """Dimension names as one comparable text, order ignored."""
    return F.array_join(F.array_sort(names), "|")


def selectable(facts: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Nested facts to the flat columns that selectors compare."""
    canonical = F.when(
        F.coalesce("measure.source_concept", "measure.concept_relation").isNotNull(),
        F.col("measure.concept"),
    )
    return facts.select(
        *keep,
        F.col("geography.level").alias("geography_level"),
        F.col("period.type").alias("period_type"),
        F.col("period.value").alias("period_value"),
        F.col("period.value_int").alias("period_int"),
        F.col("source.source_name").alias("source_name"),
        F.col("source.source_table").alias("source_table"),
        K.source_measure_id().alias("source_measure_id"),
        K.source_concept_or_concept().alias("source_concept"),
        F.coalesce(canonical, K.source_concept_or_concept()).alias("concept"),
        F.col("layout.record_set_id").alias("record_set_id"),
        F.col("layout.record_set_spec_id").alias("record_set_spec_id"),
        F.col("layout.groupby_dimension").alias("groupby_dimension"),
        name_set(
            F.map_keys(F.map_filter("filters", lambda _, v: v.isNotNull()))
        ).alias("dimensions"),
        "domain",
        F.col("entity.name").alias("entity"),
        "assertion",
        "provenance_class",
    )


def unknown_keys() -> Column:
    """Selector keys outside the supported ones."""
    known = F.array(*[F.lit(key) for key in SELECTOR_KEYS])
    return F.array_except(F.map_keys("selector"), known)


def signatures(targets: DataFrame) -> list[tuple[str, ...]]:
    """Distinct sets of selector keys in use: at most 2^13, in practice a few."""
    combos = targets.select(F.array_sort(F.map_keys("selector")).alias("s")).distinct()
    return sorted(tuple(row["s"]) for row in combos.collect())


def selector_key() -> Column:
    """Comparable text of a selector: its keys and values in key order.

    A null value is marked, so that it meets facts without that value only.
    """
    return F.array_join(
        F.transform(
            F.array_sort(F.map_entries("selector")),
            lambda item: F.concat(item["key"], stated(item["value"])),
        ),
        "|",
    )


def stated(value: Column) -> Column:
    """``=value``, or a mark that no escaped value gives."""
    return F.coalesce(F.concat(F.lit("="), C.escape(value)), F.lit("!"))


def fact_selector_key(keys: Sequence[str]) -> Column:
    """The same text for a fact: what a selector of these ``keys`` must be."""
    parts = []
    for key in keys:
        parts += [F.lit(f"{'|' if parts else ''}{key}"), stated(F.col(key))]
    return F.concat(*parts) if parts else F.lit("")


class Matcher(NamedTuple):
    """Targets and facts of one level, met through an index of key tuples.

    A tuple is what a fact has in the keys that any selector asks for; there are
    far fewer of them than facts.  Only tuples are expanded to the asked sets of
    keys, and only what a target asks for stays (``links``); facts carry their
    tuple as one text and never meet a selector themselves.
    """

    targets: DataFrame  # target_id, selector_key
    facts: DataFrame  # the facts' columns and tuple_key
    counted: DataFrame  # tuple_key, period, assertion, fact_count
    links: DataFrame  # selector_key, tuple_key

    def combinations(self) -> DataFrame:
        """``target_id``, period, assertion and number of matching facts.

        Facts are counted per tuple and period, then per selector, before they
        meet the targets, so a selector that a third of the facts satisfy costs
        one row per period.
        """
        group = ["selector_key", *PERIOD, "assertion"]
        sums = self.links.join(self.counted, "tuple_key").groupBy(*group)
        return self.targets.join(
            sums.agg(F.sum("fact_count").alias("fact_count")), "selector_key"
        ).drop("selector_key")

    def facts_at(self, chosen: DataFrame) -> DataFrame:
        """Facts of each target at its chosen period."""
        on = ["tuple_key", "period_type", "period_value"]
        asked = (
            chosen.join(self.targets, "target_id")
            .join(self.links, "selector_key")
            .drop("selector_key")
        )
        extra = [n for n in self.facts.columns if n not in on and n not in asked.columns]
        return asked.join(self.facts.select(*on, *extra), on).drop("tuple_key")


def matcher(
    targets: DataFrame,
    facts: DataFrame,
    level: str,
    parts: Sequence[Sequence[str]] | None = None,
) -> Matcher:
    """The match of ``level``; ``parts`` names the asked sets if they are known."""
    valid = at_level(targets, level).filter(F.size(unknown_keys()) == 0)
    sets = signatures(valid) if parts is None else sorted(sorted(names) for names in parts)
    used = sorted({key for names in sets for key in names})
    present = facts.filter(F.col("geography_level") == level)
    values = [stated(F.col(key)) for key in used]
    keyed = present.withColumn("tuple_key", fact_selector_key(used))
    counted = store(
        keyed.groupBy("tuple_key", *PERIOD, "assertion").agg(
            F.count(F.lit(1)).alias("fact_count"),
            # Equal in all rows of a tuple.
            F.any_value(F.array(*values).cast("array<string>")).alias("_values"),
        ),
        "tuples",
    )
    # One text per asked set, by the places of its keys in the tuple.
    places = "array(" + ", ".join(
        "array(" + ", ".join(str(used.index(key)) for key in names) + ")" if names else "cast(array() as array<int>)"
        for names in sets
    ) + ")"
    names_of = F.array(*[F.lit(key) for key in used]).cast("array<string>")
    texts = F.transform(
        F.expr(places if sets else "cast(array() as array<array<int>>)"),
        lambda at: F.array_join(
            F.transform(at, lambda i: F.concat(F.get("_names", i), F.get("_values", i))), "|"
        ),
    )
    asked = valid.select("target_id", selector_key().alias("selector_key"))
    tuples = counted.select("tuple_key", "_values", names_of.alias("_names"))
    links = (
        tuples.dropDuplicates(["tuple_key"])
        .select("tuple_key", F.explode(texts).alias("selector_key"))
        .join(asked.select("selector_key").distinct(), "selector_key", "left_semi")
    )
    return Matcher(asked, keyed, counted.drop("_values"), links)


def choose_period(matches: DataFrame, requested_type: str, requested: str) -> DataFrame:
    """As-of period choice per target over its ``combinations``.

    Whole-number periods compare as numbers, all others as text.
    """
    is_number = requested.isdigit()
    number = F.lit(int(requested) if is_number else None).cast("bigint")
    same_type = F.col("period_type") == requested_type
    exact = same_type & (F.col("period_value") == requested)
    not_after = F.when(
        F.col("period_int").isNotNull() & number.isNotNull(),
        F.col("period_int") <= number,
    ).otherwise(F.col("period_value") <= requested)
    eligible = same_type & not_after

    def latest(test: Column) -> Column:
        whole = F.count_if(test & F.col("period_int").isNull()) == 0
        as_number = F.max(F.when(test, F.col("period_int"))).cast("string")
        as_text = F.max(F.when(test, F.col("period_value")))
        return F.when(whole, as_number).otherwise(as_text)

    everything = F.lit(True)
    picked = matches.groupBy("target_id").agg(
        F.max(exact).alias("_exact"),
        latest(eligible).alias("_asof"),
        latest(everything).alias("_latest"),
        F.min("period_type").alias("_first_type"),
        F.max("period_type").alias("_last_type"),
        F.sum("fact_count").alias("matched"),
    )
    one_type = F.col("_first_type") == F.col("_last_type")
    kind = (
        F.when(F.col("_exact") | F.col("_asof").isNotNull(), requested_type)
        .when(one_type, F.col("_first_type"))
    )
    value = (
        F.when(F.col("_exact"), requested)
        .when(F.col("_asof").isNotNull(), F.col("_asof"))
        .when(one_type, F.col("_latest"))
    )
    return picked.select(
        "target_id",
        "matched",
        kind.alias("period_type"),
        value.alias("period_value"),
        F.col("_exact").alias("exact"),
    )


def declared(alignments: DataFrame) -> DataFrame:
    """``target_id, alignment, repeated``: an entry that stands more than once is
    marked and has no alignment."""
    grouped = alignments.groupBy("target_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("alignment").alias("alignment")
    )
    return grouped.select(
        "target_id",
        F.when(F.col("_n") == 1, F.col("alignment")).alias("alignment"),
        (F.col("_n") > 1).alias("repeated"),
    )


def with_alignment(targets: DataFrame, alignments: DataFrame) -> DataFrame:
    """Own alignment of each target, else the one declared for ``*``.

    A repeated entry counts as none; ``resolve`` reports it.
    """
    entries = declared(alignments)
    own = entries.filter("target_id != '*'").select(
        "target_id", F.col("alignment").alias("own_alignment")
    )
    wild = entries.filter("target_id = '*'").select("alignment").first()  # one row at most
    constant = F.lit(None if wild is None else wild["alignment"]).cast("string")
    return targets.join(own, "target_id", "left").withColumn("wild_alignment", constant)


def outcomes(
    targets: DataFrame,
    match: Matcher,
    requested_type: str,
    requested: str,
    alignments: DataFrame,
    level: str,
) -> DataFrame:
    """One row per active target: its outcome, basis, period and warning.

    Outcomes: ``resolved``, ``violation``, ``no_matching_facts``,
    ``ambiguous_period_type``, ``unknown_selector_key``.
    """
    chosen = choose_period(match.combinations(), requested_type, requested)
    active = at_level(targets, level).select(
        "target_id", F.size(unknown_keys()).alias("_unknown")
    )
    joined = with_alignment(active, alignments).join(chosen, "target_id", "left")
    exact = F.coalesce("exact", F.lit(False))
    alignment = F.coalesce("own_alignment", "wild_alignment")
    outcome = (
        F.when(F.col("_unknown") > 0, "unknown_selector_key")
        .when(F.col("matched").isNull(), "no_matching_facts")
        .when(F.col("period_value").isNull(), "ambiguous_period_type")
        .when(exact | alignment.isNotNull(), "resolved")
        .otherwise("violation")
    )
    resolved = F.col("outcome") == "resolved"
    return (
        joined.withColumn("outcome", outcome)
        .select(
            "target_id",
            "outcome",
            F.when(resolved, F.when(exact, "fact").otherwise("declared_alignment")).alias(
                "basis"
            ),
            "period_type",
            "period_value",
            F.when(resolved & ~exact, alignment).alias("alignment"),
            F.when(
                resolved & exact & F.col("own_alignment").isNotNull(), "unused_alignment"
            ).alias("warning"),
        )
    )


class Resolution(NamedTuple):
    resolved: DataFrame
    violations: DataFrame
    issues: DataFrame


def resolve(
    targets: DataFrame,
    facts: DataFrame,
    requested_type: str,
    requested: str,
    alignments: DataFrame,
    level: str = "country",
    parts: Sequence[Sequence[str]] | None = None,
    strict: bool = False,
) -> Resolution:
    """Resolved facts, violations and issues of a profile.

    ``strict`` looks for a problem (one action that stops at the first rows)
    and raises instead of returning an invalid report.
    """
    match = matcher(targets, facts, level, parts)
    state = outcomes(
        targets, match, requested_type, requested, alignments, level
    )
    done = F.col("outcome") == "resolved"
    chosen = state.filter(done).select(
        "target_id", "basis", "alignment", "period_type", "period_value"
    )
    resolved = match.facts_at(chosen)
    violations = state.filter("outcome = 'violation'").select(
        "target_id", "period_type", "period_value"
    )
    code = F.when(~done, F.col("outcome")).otherwise(F.col("warning"))
    issues = state.filter(code.isNotNull() & (F.col("outcome") != "violation")).select(
        "target_id",
        code.alias("code"),
        F.when(done, "warning").otherwise("error").alias("severity"),
    )
    repeated = declared(alignments).filter("repeated").select(
        "target_id",
        F.lit("repeated_alignment").alias("code"),
        F.lit("error").alias("severity"),
    )
    issues = issues.unionByName(repeated)
    if strict:
        bad = state.filter(~done).select("target_id", "outcome").limit(5)
        again = repeated.select("target_id", F.col("code").alias("outcome")).limit(5)
        bad = bad.unionByName(again).collect()
        if bad:
            listed = ", ".join(f"{row['target_id']}: {row['outcome']}" for row in bad)
            raise ValueError(f"profile resolution failed: {listed}")
    return Resolution(resolved, violations, issues)


def target_coverage(
    targets: DataFrame,
    facts: DataFrame,
    levels: Sequence[str],
    parts: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Per target and level: matching facts, their periods and assertions.

    The lists hold distinct periods and assertions, which are few.
    """
    result = None
    for level in levels:
        match = matcher(targets, facts, level, parts)
        period = F.concat_ws(":", "period_type", "period_value")
        counted = match.combinations().groupBy("target_id").agg(
            F.sum("fact_count").alias("matched"),
            F.array_join(F.sort_array(F.collect_set(period)), ",").alias("periods"),
            F.array_join(F.sort_array(F.collect_set("assertion")), ",").alias(
                "assertions"
            ),
        )
        part = (
            at_level(targets, level)
            .select("target_id", F.lit(level).alias("geography_level"))
            .join(counted, "target_id", "left")
            .withColumn("matched", F.coalesce("matched", F.lit(0).cast("bigint")))
        )
        result = part if result is None else result.unionByName(part)
    return result


def whole_period(value: Column) -> Column:
    """Numeric form of a whole-number period, else null."""
    return F.when(value.rlike(INTEGER_PATTERN), value.try_cast("bigint"))
