"""Operator 1: document fingerprints by consistent weighted sampling.

A document is a bag of words; a word's weight is how often it occurs.  Each
sample k gives every word three random numbers that depend only on the word and
k: r and c from Gamma(2, 1) and b from [0, 1).  With weight w,

    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1)

and the sample of the document is its least ``a``.  Two documents agree on a
sample with the probability of their generalised Jaccard similarity, the sum of
the smaller weights over the sum of the larger ones.  ``a`` is fixed by word, k
and t, so the least ``a`` itself is the sample: no argument has to be carried
along and a plain ``min`` per sample does the work, inside one aggregation.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import block_of, partitions, sort_key, split_points

SAMPLES = 64
#: Samples of one row and one aggregation.  All 64 in one made generated methods of
#: so many nodes that the JVM's compiler alone could take gigabytes beside the heap.
PER_ROW = 16


def sample_expr(term: str, log_weight: str, k: int | str) -> str:
    """SQL text of ln a for the hash ``term``, null where the weight is null.

    ``k`` is a number or the SQL text of an int.  Two 64-bit hashes give five uniform numbers, none of them 0 or 1.
    """
    one, two = f"xxhash64({term}, 2 * ({k}))", f"xxhash64({term}, 2 * ({k}) + 1)"

    def uniform(hash_: str, shift: int, bits: int) -> str:
        moved = f"shiftrightunsigned({hash_}, {shift})" if shift else hash_
        if shift + bits < 64:
            moved = f"({moved} & {2**bits - 1}L)"
        return f"(({moved} + 0.5D) * {2.0**-bits!r}D)"

    minus_r = f"ln({uniform(one, 32, 32)} * {uniform(one, 0, 32)})"
    log_c = f"ln(-ln({uniform(two, 43, 21)} * {uniform(two, 22, 21)}))"
    b = uniform(two, 0, 22)
    # Weight 1 is the common one, and then t is 0.
    t = f"if({log_weight} = 0D, 0D, floor({b} - {log_weight} / {minus_r}))"
    return f"{log_c} + {minus_r} * ({t} - {b} + 1D)"


def samples(weighted: DataFrame, key: list[str]) -> DataFrame:
    """One row per ``key`` with the arrays ``one`` and ``two`` of samples.

    ``weighted``: the key columns, ``term`` (a long hash) and the positive
    weights ``one`` and ``two`` of the term in two texts of the same key, null
    where the term is not in that text.  The array of a text without any term
    holds nulls.  A term with the same weight in both texts is sampled once.
    """
    w1, w2 = F.col("one"), F.col("two")
    entry = lambda side, w: F.struct(F.lit(side).alias("side"), F.ln(w).alias("log"))
    entries = (
        F.when(w1.eqNullSafe(w2), F.array(entry(0, w1)))
        .when(w2.isNull(), F.array(entry(1, w1)))
        .when(w1.isNull(), F.array(entry(2, w2)))
        .otherwise(F.array(entry(1, w1), entry(2, w2)))
    )
    some = range(PER_ROW)
    least = [
        F.expr(f"min({sample_expr('term', 'log', f'{PER_ROW} * part + {i}')})").alias(f"_{i}")
        for i in some
    ]
    parts = F.explode(F.array(*[F.lit(p) for p in range(SAMPLES // PER_ROW)]))
    sides = (
        weighted.select(*key, "term", F.inline(entries))
        .withColumn("part", parts)
        .groupBy(*key, "side", "part")
        .agg(*least)
    )
    both = [
        F.min(F.when(F.col("side") != 3 - text, F.col(f"_{i}"))).alias(f"_{text}_{i}")
        for text in (1, 2)
        for i in some
    ]
    array = lambda text: F.array(*[F.col(f"_{text}_{i}") for i in some])
    pieces = F.struct("part", array(1).alias("one"), array(2).alias("two"))
    return (
        sides.groupBy(*key, "part")
        .agg(*both)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(pieces)).alias("pieces"))
        .select(*key, *[F.flatten(f"pieces.{n}").alias(n) for n in ("one", "two")])
    )


def likeness(left: Column, right: Column) -> Column:
    """Share of equal samples; two documents without terms are alike."""
    same = F.zip_with(left, right, lambda a, b: a.eqNullSafe(b).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.lit(float(SAMPLES))


def as_text(sample: Column) -> Column:
    """Four hexadecimal digits per sample; the empty text without terms."""
    digits = F.transform(
        sample, lambda a: F.lower(F.lpad(F.hex(F.xxhash64(a).bitwiseAND(65535)), 4, "0"))
    )
    return F.when(sample[0].isNull(), F.lit("")).otherwise(F.concat_ws("", digits))


def with_next(documents: DataFrame) -> DataFrame:
    """Each document beside the one after it in ascending ``doc_id``.

    Returns block, key, real, text, next_text; the first follows the last.  Null
    ids come first; rows with the same id are ordered by text.  A null text is
    empty.  The rows are cut into blocks at quantiles of the ids.  The first
    rows of a block also stand at the end of the block before (``real`` is
    false there), so that no step needs all rows in one place.
    """
    rows = documents.select(
        sort_key("doc_id").alias("key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # A block's rows meet in one task: quantiles, so the blocks are even.
    pieces = 4 * partitions(documents.sparkSession)
    points = split_points(rows, "key", pieces)
    rows = rows.withColumn("block", block_of("key", points))
    firsts = {  # one id per block: at most ``pieces`` rows
        r["block"]: r["first"]
        for r in rows.groupBy("block").agg(F.min("key").alias("first")).collect()
    }
    order = sorted(firsts)
    before = {firsts[b]: order[i - 1] for i, b in enumerate(order)}
    rows = rows.withColumn("real", F.lit(True))
    if before:
        places = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
        guests = (
            rows.filter(F.col("key").isin(list(before)))
            .withColumn("block", places[F.col("key")])
            .withColumn("real", F.lit(False))
        )
        rows = rows.unionByName(guests)
    rows = rows.repartitionByRange(partitions(documents.sparkSession), "block")
    within = Window.partitionBy("block").orderBy(F.desc("real"), "key", "text")
    return rows.withColumn("at", F.row_number().over(within)).withColumn(
        "next_text", F.lead("text").over(within)
    )


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and likenesses.

    The words of both texts are counted and sampled in the block of the
    document, so the whole texts are shuffled once.
    """
    rows = with_next(spark.read.parquet(f"{folder}/documents.parquet"))
    kept = F.expr("n_chars - n_chars div 4")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited",
        F.concat(
            F.substring(F.col("text"), F.lit(1), kept.cast("int")),
            F.substring(
                F.col("next_text"), F.lit(1), F.expr("n_chars div 4").cast("int")
            ),
        ),
    )
    rows = rows.withColumn("edited", F.coalesce("edited", "text"))  # guests: unused
    key = ["block", "at", "key", "real", "n_chars", "edited_sha256"]
    rows = rows.withColumn("edited_sha256", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    sides = F.array(
        F.struct(F.lit(True).alias("own"), F.col("text").alias("text")),
        F.struct(F.lit(False).alias("own"), F.col("edited").alias("text")),
    )
    words = (
        rows.select(*key, F.explode(sides).alias("side"))
        .select(
            *key,
            F.col("side.own").alias("own"),
            F.explode(F.split(F.col("side.text"), r"[ \t-\r]+")).alias("word"),
        )
        .select(
            *key,
            F.xxhash64("word").alias("term"),
            F.expr("int(own and word != '')").alias("own"),
            F.expr("int(not own and word != '')").alias("edit"),
        )
    )
    weighted = words.groupBy(*key, "term").agg(
        F.expr("nullif(sum(own), 0)").cast("double").alias("one"),
        F.expr("nullif(sum(edit), 0)").cast("double").alias("two"),
    )
    found = samples(weighted, key)
    within = Window.partitionBy("block").orderBy("at")
    return (
        found.withColumn("after", F.lead("one").over(within))
        .filter("real")
        .select(
            F.when(F.col("key") != -(2**63), F.col("key")).alias("doc_id"),
            "n_chars",
            F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
            as_text(F.col("one")).alias("fingerprint"),
            as_text(F.col("two")).alias("edited_fingerprint"),
            likeness(F.col("one"), F.col("two")).alias("near_edited"),
            likeness(F.col("one"), F.col("after")).alias("near_next"),
        )
    )
