"""Operator 13: language identification by error-correcting output codes.

Every learned language has a codeword of +1 and -1 bits.  One binary naive Bayes
classifier per bit, over hashed character n-grams of words, tells the languages
with +1 from those with -1.  A text's languages are ranked by the loss of its
bits' margins against each codeword; a narrow win is flagged.

Counting is one pass over all labelled texts: a task adds up counts per language
and bucket, Spark sums them.  What comes to the driver and goes to the workers
is one number per bucket and language or bit, whatever the size of the input.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: n-grams of up to ORDER characters are hashed to this many buckets.
ORDER, BUCKETS = 4, 2**17
#: Counts added to every bucket of a language.
SMOOTHING = 0.05
#: Longer texts are read in pieces of this many characters.
PIECE = 200_000
#: A win of less than this share of the belief is flagged.
CLEAR = 0.1
#: A text's n-grams overlap and repeat, so they never count as more than this many.
EVIDENCE = 100
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+").findall
_ODD = np.uint64(0x9E3779B97F4A7C15)


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language, columns are bits.

    Up to seven languages: every split of them into two sides, so any two rows
    differ in about half of all bits.  More: rows of a Hadamard matrix without
    its constant column, where any two rows differ in exactly half of the bits.
    """
    if n <= 1:
        return np.ones((n, 0), np.int8)
    if n <= 7:
        splits = np.arange(1, 2 ** (n - 1))  # the first language is always +1
        bits = (splits[None, :] >> np.maximum(np.arange(n) - 1, 0)[:, None]) & 1
        bits[0] = 0
        return (1 - 2 * bits).astype(np.int8)
    size = 1 << (n - 1).bit_length()
    cross = np.arange(n)[:, None] & np.arange(1, size)[None, :]
    odd = np.zeros_like(cross)
    for shift in range(size.bit_length()):
        odd ^= (cross >> shift) & 1
    return (1 - 2 * odd).astype(np.int8)


def letters(text: str) -> str:
    """The words of ``text`` in lower case with a space around each; no letters: empty."""
    words = _WORDS(text.lower())
    if not any(c.isalpha() for word in words for c in word):
        return ""
    return f" {' '.join(words)} "


def pieces(text: str | None):
    for at in range(0, len(text or ""), PIECE):
        some = letters(text[at : at + PIECE])
        if some:
            yield some


def buckets(some: str) -> np.ndarray:
    """Buckets of all n-grams of one piece."""
    points = np.frombuffer(some.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found, code = [], np.zeros(len(points), np.uint64)
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    with np.errstate(over="ignore"):
        for n in range(1, ORDER + 1):
            if len(points) < n:
                break
            code = (code[: len(points) - n + 1] * _ODD + points[n - 1 :] + np.uint64(n)) * _ODD
            code ^= code >> np.uint64(29)
            found.append((code * _ODD) >> shift)
    return np.concatenate(found).astype(np.int64)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """lang, bucket, n over all rows of ``labelled`` (lang, text)."""

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                for some in pieces(text):
                    total = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    place, times = np.unique(buckets(some), return_counts=True)
                    total[place] += times
        for lang, total in held.items():
            seen = np.flatnonzero(total)
            for at in range(0, len(seen), 20_000):
                part = seen[at : at + 20_000]
                yield pd.DataFrame({"lang": lang, "bucket": part, "n": total[part]})

    rows = labelled.select("lang", "text").mapInPandas(count, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Learned languages in order, their codewords, and a weight per bucket and bit."""

    def __init__(self, languages: list[str], words: np.ndarray, weights: np.ndarray):
        self.languages, self.words, self.weights = languages, words, weights

    def margins(self, text: str | None) -> np.ndarray | None:
        """Log odds of each bit, by at most EVIDENCE n-grams; None without letters."""
        total, n = np.zeros(self.words.shape[1]), 0
        for some in pieces(text):
            found = buckets(some)
            n += len(found)
            total += self.weights[found].sum(axis=0, dtype=np.float64)
        return total * (EVIDENCE / (EVIDENCE + n)) if n else None

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Logistic loss of the margins against each codeword, bits weighing alike."""
        return np.logaddexp(0, -self.words * margins).sum(axis=1)

    def decide(self, text: str | None) -> tuple[str, float, bool, str | None]:
        """Language, belief, whether it is ambiguous, and the runner-up."""
        margins = self.margins(text)
        if margins is None or not self.languages:
            return UNKNOWN, 0.0, False, None
        loss = self.losses(margins)
        order = np.argsort(loss, kind="stable")  # equal losses: the first by name
        # Two codewords differ in about half of the bits, each of which repeats
        # the same evidence.
        share = np.exp((loss[order[0]] - loss) / max(1, self.words.shape[1] / 2))
        share /= share.sum()
        best = float(share[order[0]])
        if len(order) == 1:
            return self.languages[0], best, False, None
        second = float(share[order[1]])
        return self.languages[order[0]], best, best - second < CLEAR, self.languages[order[1]]


def train(labelled: DataFrame) -> Model:
    """Learn from all rows of ``labelled`` (lang, text) with a non-null lang."""
    rows = gram_counts(labelled.filter("lang is not null and text is not null")).toArrow()
    names = np.array(rows.column("lang").to_pylist(), object)
    languages = sorted(set(names))
    at = np.array([{l: i for i, l in enumerate(languages)}[x] for x in names], np.int64)
    counts = np.zeros((len(languages), BUCKETS))
    if len(names):
        counts[at, rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    counts += SMOOTHING
    chance = counts / counts.sum(axis=1, keepdims=True)
    words = codewords(len(languages))
    weights = np.zeros((BUCKETS, words.shape[1]), np.float32)
    for bit in range(words.shape[1]):
        # Each language of a side weighs alike, however many texts it has.
        one, other = (chance[words[:, bit] == side].mean(axis=0) for side in (1, -1))
        weights[:, bit] = np.log(one / other)
    return Model(languages, words, weights)


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``_lang``: lang, score, ambiguous, second.

    Only ``text`` is read.  A text that is null or has no letters is ``und``
    with score 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, ambiguous boolean, second string")
    def decide(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.decide(text) for text in texts]
        return pd.DataFrame(found, columns=["lang", "score", "ambiguous", "second"])

    return documents.withColumn("_lang", decide(F.col("text")))


def identified(documents: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous, second of every document.

    ``documents``: doc_id, text, lang; other columns are ignored.  The model
    learns from the texts with a language outside fold 0 of crc32(doc_id); a
    null id counts as an empty text and is in fold 0.  Repeated rows are judged
    alike.  Where nothing can be learned every text is ``und``.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = documents.select(
        "doc_id", "text", "lang", (F.crc32(key.cast("binary")) % folds == 0).alias("held_out")
    )
    model = train(rows.filter(~F.col("held_out")))
    return predicted(rows.drop("lang"), model).select(
        "doc_id",
        "held_out",
        F.col("_lang.lang").alias("lang_pred"),
        F.col("_lang.score").alias("score"),
        F.col("_lang.ambiguous").alias("ambiguous"),
        F.col("_lang.second").alias("second"),
    )


def fold(doc_id, folds: int = 5) -> int:
    """The fold of one id, as the query computes it."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    return identified(spark.read.parquet(f"{folder}/documents.parquet"))
