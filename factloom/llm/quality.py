"""Operator 9: quality by an interpolated modified Kneser-Ney model.

The model is trained on trusted text and reads a document as its code points, in
grams of four; there is no fixed alphabet, so its tables grow with the trusted
texts.  Counting is a Spark aggregation over the trusted texts; each order is a
table (context, symbol, share) beside one (context, rest), all sharded by context.
Documents are dealt into chunks of some megabytes, and a chunk asks for each of
its distinct grams once: these meet the tables in equi-joins, order by order, and
the likelihoods meet the chunk's documents in a cogroup.  Nothing of the model is
collected or broadcast by this code.

A document's perplexity is compared with a quantile of the perplexities of the
trusted documents of its language.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import (
    SPACES,
    block_of,
    if_few,
    null_safe_join,
    sort_key,
    split_points,
    stored,
)
from .symbol_model import (  # noqa: F401  (the tests of the bounded model read it here)
    ORDER,
    REPEAT,
    SYMBOLS,
    _discounts,
    gram_counts,
    grams,
    segments,
    symbols,
    train,
    without_repeats,
)

#: Symbols beyond the code points: around a text, and for a repeated word.
EDGE, AGAIN = 0x110000, 0x110001
#: Bits of a symbol; the three before it fill 63.
BITS = 21
MASK = (1 << BITS) - 1
#: The model of all trusted texts; model 0 or 1 is that for texts of this fold.
ALL = 2
#: Bytes of text in a chunk, at most and at least; one row is never cut.
MOST, LEAST = 12 * 2**20, 2**20
#: Characters that are worked on together.
GROUP = 500_000
#: Distinct grams that a task holds before it gives them away.
HELD = 1_000_000

_KEY = ["_s_model", "_s_chunk"]
_GRAM = ["context", "symbol"]


def _blank() -> np.ndarray:
    table = np.zeros(AGAIN + 1, bool)
    space = re.compile(f"[{SPACES}]")
    table[[i for i in range(0x3001) if space.match(chr(i))]] = True
    table[EDGE] = True
    return table


_BLANK = _blank()


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, three edges before each; starts and lengths.

    The length of a text counts one edge behind its last character.
    """
    gap = "\0" * (ORDER - 1)
    joined = gap + gap.join(texts) + gap
    found = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = ORDER - 1 + np.concatenate([[0], np.cumsum(lengths + ORDER - 1)[:-1]])
    for back in range(1, ORDER):
        found[starts - back] = EDGE
    found[1 - ORDER :] = EDGE
    found, starts, lengths = without_repeats(found, starts, lengths, _BLANK[found], EDGE, AGAIN)
    return found, starts, lengths + 1


def contexts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The three symbols before each symbol of the texts, in 63 bits, and the
    symbol; where each text's symbols start, and how many they are."""
    found, starts, lengths = characters(texts)
    first = np.cumsum(lengths) - lengths
    at = np.arange(lengths.sum()) + np.repeat(starts - first, lengths)
    context = found[at - 3] << (2 * BITS) | found[at - 2] << BITS | found[at - 1]
    return context, found[at], first, lengths


def _summed(context: np.ndarray, symbol: np.ndarray, n: np.ndarray | None = None):
    """Distinct grams and how often they are there (``n``: times each)."""
    ids, known = pd.factorize(context)
    place, code = pd.factorize(ids << BITS | symbol)
    counts = np.bincount(place, weights=n).astype(np.int64)
    return known[code >> BITS], code & MASK, counts


def counted_grams(rows: DataFrame, key: list[str]) -> DataFrame:
    """How often each gram is in the texts of a ``key``: key, context, symbol, n;
    where tasks share a key, a gram may have several rows, which add up."""

    def merged(parts):
        return _summed(*(np.concatenate(column) for column in zip(*parts)))

    def given(held):
        for values, parts in held.items():
            context, symbol, n = merged(parts)
            for at in range(0, len(context), 100_000):
                cut = slice(at, at + 100_000)
                frame = {"context": context[cut], "symbol": symbol[cut], "n": n[cut]}
                yield pd.DataFrame(dict(zip(key, values)) | frame)

    def count(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            for values, some in batch.groupby(key):
                parts = held.setdefault(values, [])
                for piece in segments(some["text"], GROUP):
                    context, symbol, _, _ = contexts([text for _, text in piece])
                    parts.append(_summed(context, symbol))
                    if len(parts) > 8:
                        parts[:] = [merged(parts)]
            if sum(len(c) for parts in held.values() for c, _, _ in parts) > HELD:
                yield from given(held)
                held.clear()
        yield from given(held)

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    shape = ", ".join([f"{c} {types[c]}" for c in key] + ["context long, symbol long, n long"])
    return rows.select(*key, "text").mapInPandas(count, shape)


def orders(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """The models of ``counts`` (fold, context, symbol, n), from order 1 on.

    Per order two tables: _s_model, context, symbol, share and _s_model, context,
    rest, the weight of the shorter gram.  Model 0 is trained without fold 0, 1
    without 1 and ``ALL`` with both.
    """
    models = F.explode(F.array(F.lit(ALL), F.lit(1) - F.col("fold"))).alias("_s_model")
    table = counts.select(models, *_GRAM, "n").groupBy("_s_model", *_GRAM)
    tables = {ORDER: stored(table.agg(F.sum("n").alias("n")), "grams")}
    for k in range(ORDER - 1, 0, -1):  # in how many contexts a shorter gram is seen
        shorter = tables[k + 1].withColumn("context", _last(k - 1)).groupBy("_s_model", *_GRAM)
        tables[k] = stored(shorter.agg(F.count("*").alias("n")), "grams")
    made = []
    for k in range(1, ORDER + 1):
        # At most five rows per model.
        seen = tables[k].groupBy("_s_model", F.least("n", F.lit(5)).alias("n")).count().collect()
        cut = F.lit(None).cast("double")
        for model in sorted({r["_s_model"] for r in seen}):
            of = {r["n"]: r["count"] for r in seen if r["_s_model"] == model}
            one, two, more = _discounts(of)
            some = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
            cut = F.when(F.col("_s_model") == model, some).otherwise(cut)
        rest = tables[k].groupBy("_s_model", "context").agg(
            F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("rest")
        )
        shares = tables[k].withColumn("cut", cut).join(
            rest.select("_s_model", "context", "total"), ["_s_model", "context"]
        )
        share = ((F.col("n") - F.col("cut")) / F.col("total")).alias("share")
        made.append((shares.select("_s_model", *_GRAM, share), rest.drop("total")))
    return made


def _last(n: int) -> Column:
    """The last ``n`` symbols of a context."""
    return F.col("context").bitwiseAND(F.lit((1 << (BITS * n)) - 1).cast("long"))


def likelihoods(asked: DataFrame, made: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``asked`` (_s_model, context, symbol) with ``nll``, by joins with each order."""
    rows, chance = asked.withColumnRenamed("context", "_whole"), F.lit(1 / EDGE)
    for k, (shares, rest) in enumerate(made, 1):
        rows = rows.withColumn("context", F.col("_whole")).withColumn("context", _last(k - 1))
        rows = rows.join(shares, ["_s_model", *_GRAM], "left").join(
            rest, ["_s_model", "context"], "left"
        )
        chance = F.coalesce("share", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * chance
        rows = rows.withColumn("_chance", chance).drop("context", "share", "rest", "_shorter")
        rows = rows.withColumnRenamed("_chance", "_shorter")
        chance = F.col("_shorter")
    nll = (-F.log(chance)).alias("nll")
    return rows.select("_s_model", F.col("_whole").alias("context"), "symbol", nll)


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text and others) with ``_s_chunk``.

    Chunks are ranges of doc_id, as neighbours share a task when they are read;
    where repeated ids make one too large, it is dealt by text as well.
    """
    spark = rows.sparkSession
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = rows.agg(F.sum(size)).first()[0] or 0
    room = min(max(total // (4 * spark.sparkContext.defaultParallelism), LEAST), MOST)
    keyed = rows.select(sort_key("doc_id").alias("_s_id"), size.alias("_s_size"))
    points = split_points(keyed, "_s_id", -(-total // room) or 1)
    block = lambda: block_of("_s_id", points)
    sizes = keyed.groupBy(block().alias("_s_block")).agg(F.sum("_s_size").alias("_s_size"))
    # One row per range that is too large, at most as many as there are ranges.
    large = sizes.filter(F.col("_s_size") > 4 * room).select(
        "_s_block", F.expr(f"_s_size div {room} + 1").alias("_s_parts")
    )
    large = {r["_s_block"]: r["_s_parts"] for r in large.collect()}

    part = F.lit(0).cast("long")
    if large:
        of = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
        parts = F.coalesce(F.try_element_at(of, F.col("_s_block")), F.lit(1))
        part = F.pmod(F.xxhash64("text"), parts.cast("long"))
    chunk = (F.col("_s_block") + part * F.lit(len(points) + 1)).cast("long")
    rows = rows.withColumn("_s_id", sort_key("doc_id")).withColumn("_s_block", block())
    return rows.withColumn("_s_chunk", chunk).drop("_s_id", "_s_block")


def scored(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with _s_n, its number of symbols, and _s_nll, from the likelihoods
    ``known`` (_s_model, _s_chunk, context, symbol, nll) of their chunk."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        held = [right.column(c).to_numpy() for c in ("context", "symbol", "nll")]
        ids, _ = pd.factorize(held[0])  # a gram that two tasks asked for is there twice
        once = ~pd.Series(ids << BITS | held[1]).duplicated().to_numpy()
        held = [column[once] for column in held]
        some = len(held[0])
        n, nll = np.zeros(len(left), np.int64), np.zeros(len(left))
        for piece in segments(left.column("text").to_pylist(), GROUP):
            context, symbol, starts, lengths = contexts([text for _, text in piece])
            ids, _ = pd.factorize(np.concatenate([held[0], context]))
            code = ids << BITS | np.concatenate([held[1], symbol])
            at = pd.Index(code[:some]).get_indexer(code[some:])
            if (at < 0).any():
                raise ValueError("a chunk has a gram that was not asked for")
            texts = [row for row, _ in piece]
            np.add.at(n, texts, lengths)
            np.add.at(nll, texts, np.add.reduceat(held[2][at], starts))
        return left.append_column("_s_n", pa.array(n)).append_column("_s_nll", pa.array(nll))

    shape = StructType(
        [*rows.schema, StructField("_s_n", LongType()), StructField("_s_nll", DoubleType())]
    )
    return rows.groupBy(*_KEY).cogroup(known.groupBy(*_KEY)).applyInArrow(score, shape)


def only(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``documents`` whose doc_id is in ``ids``; broadcast if few."""
    ids = ids.select("doc_id").filter("doc_id is not null").distinct()
    return documents.join(if_few(ids), "doc_id", "left_semi")


def judged(
    documents: DataFrame,
    labels: DataFrame,
    quantile: float = 0.998,
    prior: float = 60.0,
) -> DataFrame:
    """``documents`` with n_symbols, perplexity, threshold and keep.

    ``documents``: doc_id, text, lang and any other columns; ``labels``: doc_id
    and quality, of which those with quality 1 are trusted.  ``prior`` symbols
    at the mean of the language are added to each text, as a short text says
    little.  The threshold is the ``quantile`` of the trusted texts of the same
    language, each half scored by a model of the other half; a language (or a
    null one) without trusted text takes that of all
    trusted texts.  Without any trusted text everything is kept and perplexity
    and threshold are null.  A null text is empty.
    """
    trusted = only(
        documents.select("doc_id", "text", "lang"),
        labels.filter(F.col("quality") == 1),
    )
    # Copies of a text are in one fold.
    fold = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")
    trusted = trusted.withColumn("fold", fold)
    counts = counted_grams(trusted, ["fold"]).groupBy("fold", *_GRAM)
    counts = stored(counts.agg(F.sum("n").alias("n")), "folds")
    folds = [r["fold"] for r in counts.select("fold").distinct().collect()]
    taken = {c: f"_{c}" for c in ("n_symbols", "perplexity", "threshold", "keep")}
    documents = documents.withColumnsRenamed(
        {c: n for c, n in taken.items() if c in documents.columns}
    )
    if not folds:
        return documents.selectExpr(
            "*",
            "cast(null as bigint) as n_symbols",
            "cast(null as double) as perplexity",
            "cast(null as double) as threshold",
            "true as keep",
        )

    made = orders(counts)
    # Each fold is scored by the model of the other one: new text fares like that.
    other = F.col("fold") if len(folds) == 2 else F.lit(ALL)
    trusted = trusted.select("doc_id", "text", "lang", other.alias("_s_model"))
    trusted = dealt(trusted)
    documents = dealt(documents.withColumn("_s_model", F.lit(ALL)))
    asked = [stored(counted_grams(rows, _KEY).drop("n"), "asked") for rows in (documents, trusted)]
    gram = ["_s_model", *_GRAM]
    every = asked[0].select(gram).unionByName(asked[1].select(gram)).distinct()
    found = stored(likelihoods(every, made), "likelihoods")
    known = scored(trusted, asked[1].join(found, gram))
    known = known.select("lang", F.col("_s_n").alias("n"), F.col("_s_nll").alias("nll"))
    known = stored(known, "trusted")
    mean = (F.sum("nll") / F.sum("n")).alias("mean")
    shrunk = (F.col("nll") + prior * F.col("mean")) / (F.col("n") + prior)
    cut = F.percentile_approx(shrunk, quantile, 10_000).alias("cut")
    means = known.groupBy("lang").agg(mean)

    per_language = null_safe_join(known, means, ["lang"]).groupBy("lang", "mean").agg(cut)
    overall = known.agg(mean).first()["mean"]
    all_cut = known.withColumn("mean", F.lit(overall)).agg(cut).first()["cut"]
    # One row per language; null stands beside the languages, not among them.
    limits = per_language.select(
        F.col("lang").alias("_l"), F.col("mean").alias("_mean"), F.col("cut").alias("_cut")
    )
    # The few limits go to the texts.
    rows = scored(documents, asked[0].join(found, gram)).join(
        if_few(stored(limits, "limits")), F.col("lang").eqNullSafe(F.col("_l")), "left"
    )
    mean, cut = F.coalesce("_mean", F.lit(overall)), F.coalesce("_cut", F.lit(all_cut))
    value = (F.col("_s_nll") + prior * mean) / (F.col("_s_n") + prior)
    return (
        rows.withColumn("n_symbols", F.col("_s_n"))
        .withColumn("perplexity", F.exp(value))
        .withColumn("threshold", F.exp(cut))
        .withColumn("keep", F.col("perplexity") <= F.col("threshold"))
        .drop("_s_n", "_s_nll", *_KEY, "_l", "_mean", "_cut")
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity, threshold and verdict of every document."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    documents = read("documents").select("doc_id", "text", "lang")
    return judged(documents, read("labels")).select(
        "doc_id", "lang", "n_symbols", "perplexity", "threshold", "keep"
    )
