"""Operator 7: url verdicts by rules, else by words in host and path.

Host names run words together.  A unigram model, counted over the words of the
pages themselves, splits each host label into its likeliest words (Viterbi).
Multinomial naive Bayes, trained on the pages that a rule decides and on a few
seed words, then scores the words of host and path of the others.

Only distinct host labels are split, and only distinct (host words, path words)
are scored; both are joined back to the pages.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: (verdict, host, path): fits the host and its subdomains if the path starts so.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words that hold ``SEED_SHARE`` of the mass of blocked urls, evenly.
SEEDS = "adult bets bet casino farm free poker porn sex spam viagra win xxx".split()
SEED_SHARE = 0.1
#: Share of each class's mass that all words hold evenly, seen or not.  Shares, not
#: counts: verdicts do not change with the table's size.
SMOOTHING = 0.1
#: No word of a host label is longer.
LONGEST = 20
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _CAPITALS, _CAPITALS.lower()), path


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as its text and its verdict, else null."""
    text, verdict = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for what, domain, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        text, verdict = text.when(fits, domain + start), verdict.when(fits, what)
    return text, verdict


def outside_rules(path: Column, rules=RULES) -> Column:
    """``path`` without the leading parts that the rules look at, of any value."""
    depth = max([p.count("/") - 1 for _, _, p in rules], default=0)
    return F.regexp_replace(path, f"^(?:/[^/]*){{{depth}}}(?=/)", "") if depth > 0 else path


def split_label(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words of ``label`` under unigram ``counts``.

    An unseen word of n letters has the probability 10^-n / total, so a label
    without known words stays whole.
    """
    best, back = [0.0], [0]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            seen = counts.get(label[start:end], 0)
            size = end - start
            cost = math.log(total) - (math.log(seen) if seen else -size * math.log(10))
            options.append((best[start] + cost, start))
        cost, start = min(options)
        best.append(cost)
        back.append(start)
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def host_words(hosts: DataFrame, text: DataFrame, leave: Sequence[str] = ()) -> DataFrame:
    """``host`` and the array ``words`` of each distinct host.

    ``text``: ``html``; the words of the pages, without tags, are the unigram
    model.  The parts of the labels are joined with the counted words, so no
    task holds the vocabulary.  Labels in ``leave`` are left out.
    """
    labels = hosts.select(
        "host", F.posexplode(F.split("host", r"[^a-z]+")).alias("at", "label")
    ).filter(~F.col("label").isin("", *leave))
    labels = stored(labels, "labels")
    distinct = labels.select("label").distinct()
    starts = F.sequence(F.lit(1), F.length("label"))
    parts = distinct.select("label", F.explode(starts).alias("start")).select(
        "label",
        "start",
        F.explode(
            F.sequence(
                F.lit(1), F.least(F.lit(LONGEST), F.length("label") - F.col("start") + 1)
            )
        ).alias("size"),
    )
    parts = parts.select("label", F.expr("substring(label, start, size)").alias("word")).distinct()
    plain = F.lower(F.regexp_replace("html", r"<[^>]*>", " "))
    words = text.select(F.explode(F.split(plain, r"[^a-z]+")).alias("word")).filter("word != ''")
    counted = stored(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = (
        parts.join(counted, "word")
        .groupBy("label")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))
    )

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series(
            [split_label(x, dict(k) if k is not None else {}, total + 1) for x, k in zip(label, known)]
        )

    found = distinct.join(known, "label", "left").select(
        "label", split("label", "known").alias("words")
    )
    joined = labels.join(found, "label").groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts")
    )
    return joined.select("host", F.flatten("parts.words").alias("words"))


def judged_urls(pages: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page.

    ``pages``: page_id, url and html; other columns are ignored.  ``score`` is
    the log odds of block against allow, null where a rule decides; the verdict is
    block above 0.  Without
    blocked training pages the seeds alone stand for block.  Words of the rules'
    domains and leading path parts, which decide the class, are left out, and the classes have even priors: how many pages the
    rules pick for either says nothing of the others.
    A null url has an empty host and path and the score 0.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("rule", rule)
        .withColumn("ruled", verdict)
    )
    # Numbers differ from page to page; all of them are one word.
    digits = F.regexp_replace(F.lower(outside_rules(F.col("path"), rules)), r"[0-9]+", "0")
    rows = stored(
        rows.withColumn("path_words", F.filter(F.split(digits, r"[^a-z0-9]+"), lambda w: w != "")),
        "urls",
    )
    kinds = rows.groupBy("host", "path_words", "ruled").agg(F.count("*").alias("pages"))
    kinds = stored(kinds, "kinds")
    named = sorted({w for _, domain, _ in rules for w in re.split("[^a-z]+", domain) if w})
    names = host_words(kinds.select("host").distinct(), pages, named)
    words = F.coalesce("words", F.array().cast("array<string>"))
    words = F.coalesce("words", F.array().cast("array<string>"))
    tokens = F.concat(
        F.transform(words, lambda w: F.concat(F.lit("h:"), w)),
        F.transform("path_words", lambda w: F.concat(F.lit("p:"), w)),
    )
    kinds = stored(
        kinds.join(names, "host", "left").withColumn("tokens", tokens).drop("words"), "tokens"
    )
    seen = kinds.filter("ruled is not null").select(
        F.explode("tokens").alias("token"), "ruled", "pages"
    )
    spark = pages.sparkSession
    given = spark.createDataFrame([("h:" + w, True) for w in seeds], "token string, seed boolean")
    pages_of = lambda c: F.coalesce(F.sum(F.when(F.col("ruled") == c, F.col("pages"))), F.lit(0))
    counts = seen.groupBy("token").agg(
        pages_of("block").alias("block"), pages_of("allow").alias("allow")
    )
    counts = counts.join(given, "token", "full").na.fill({"block": 0, "allow": 0, "seed": False})
    counts = stored(counts, "token-counts")
    sums = counts.agg(
        F.coalesce(F.sum("block"), F.lit(0)).alias("block"),
        F.coalesce(F.sum("allow"), F.lit(0)).alias("allow"),
        F.count("*").alias("tokens"),
    ).first()
    even = 1 / max(1, sums["tokens"])
    seeded = F.when(F.col("seed"), 1 / max(1, len(seeds))).otherwise(0.0)

    def share(c):
        held = F.col(c) / F.lit(float(sums[c])) if sums[c] else None
        if c == "block" and seeds:
            held = seeded if held is None else SEED_SHARE * seeded + (1 - SEED_SHARE) * held
        return F.lit(even) if held is None else SMOOTHING * even + (1 - SMOOTHING) * held

    weights = counts.select("token", (F.ln(share("block")) - F.ln(share("allow"))).alias("weight"))
    open_ = kinds.filter("ruled is null").select("host", "path_words", "tokens")
    scored = (
        open_.select("host", "path_words", F.explode("tokens").alias("token"))
        .join(weights, "token")
        .groupBy("host", "path_words")
        .agg(F.sum("weight").alias("sum"))
    )
    score = F.when(F.col("rule").isNull(), F.coalesce("sum", F.lit(0.0)))
    return (
        rows.join(scored, ["host", "path_words"], "left")
        .withColumn("score", score)
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce(
                "ruled", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
            ).alias("verdict"),
            "score",
        )
    )


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judged_urls(spark.read.parquet(f"{folder}/pages.parquet"))
