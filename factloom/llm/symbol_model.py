"""A bounded Kneser-Ney model over 64 symbols, as one dense table.

No query uses it: operator 9 reads whole code points (``quality``).  Its tests
stand, and hold the discounts and the folding of repeated words that operator 9
shares with it.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sole_use, stored

SYMBOLS, ORDER = 64, 4
#: The one symbol of a word that repeats the word before it, and of their gap.
REPEAT = 63
#: Characters that have a symbol of their own besides letters and digits.
MARKS = ".,'-!?:;()\"" + "|%&$*#@=_/\\+<>"
_EDGE = "\U0010ffff"
#: Longer texts are scored in segments of this many characters.
SEGMENT = 1_000_000
#: Characters of shorter texts that are worked on together.
GROUP = 150_000


def alphabet() -> np.ndarray:
    """Code point to symbol: 0 edge, 1-26 letters, 27 digits, 28-29 white
    space, 30-54 marks, 55-58 other Latin letters, 59-61 everything else."""
    points = np.arange(0x110000)
    table = (59 + points % 3).astype(np.uint8)
    table[0xC0:0x250] = 55 + points[0xC0:0x250] % 4
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = 1 + i
    table[ord("0") : ord("9") + 1] = 27
    table[[ord(c) for c in "\n\r"]] = 29
    table[[ord(c) for c in " \t\x0b\x0c\xa0"]] = 28
    for i, mark in enumerate(MARKS):
        table[ord(mark)] = 30 + i
    table[ord(_EDGE)] = 0
    return table


_ALPHABET = alphabet()


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, three edges before each; starts and lengths.

    The length of a text counts one edge behind its last character.
    """
    edge = _EDGE * (ORDER - 1)
    joined = edge + edge.join(texts) + edge
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    found = _ALPHABET[points]
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = ORDER - 1 + np.concatenate([[0], np.cumsum(lengths + ORDER - 1)[:-1]])
    blank = (found == 28) | (found == 29) | (found == 0)
    found, starts, lengths = without_repeats(found, starts, lengths, blank, 0, REPEAT)
    return found, starts, lengths + 1


def without_repeats(found, starts, lengths, blank, edge: int, repeat: int):
    """A word equal to the word before it becomes ``repeat``, without their gap.

    ``found`` holds the symbols of texts that begin at ``starts``, with at least
    three of ``edge`` around each; ``blank`` says which are white space or edges.
    """
    # Words are compared by a hash of their symbols.
    edges = np.flatnonzero(np.diff(np.r_[True, blank, True]))
    first, last = edges[::2], edges[1::2]
    if len(first):
        size = last - first
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(first, size) + inside
        with np.errstate(over="ignore"):
            part = (found[at].astype(np.uint64) + np.uint64(1)) * _weights(int(size.max()))[inside]
            word = np.add.reduceat(part, np.cumsum(size) - size)
        again = np.r_[False, (word[1:] == word[:-1]) & (size[1:] == size[:-1])]
        # Not across an edge, which may have white space on both sides.
        passed = np.cumsum(found == edge)
        again[1:] &= passed[first[1:]] == passed[last[:-1] - 1]
        found = found.copy()
        found[first[again]] = repeat
        kept = np.ones(len(found), bool)
        kept[at[np.repeat(again, size) & (inside > 0)]] = False
        kept[first[again] - 1] = False
        before = np.concatenate([[0], np.cumsum(kept)])
        lengths = before[starts + lengths] - before[starts]
        found, starts = found[kept], before[starts]
    return found, starts, lengths


def _weights(n: int) -> np.ndarray:
    """Odd multipliers per place in a word."""
    x = np.arange(1, n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) | np.uint64(1)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of the four-gram that ends at each symbol of the texts, in order;
    where each text's codes start, and how many they are."""
    found, starts, lengths = symbols(texts)
    code = np.zeros(len(found) - ORDER + 1, np.int32)
    for j in range(ORDER):
        code = code * SYMBOLS + found[j : j + len(code)]
    at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)])
    return code[at - ORDER + 1], np.cumsum(lengths) - lengths, lengths


def segments(texts, room: int = GROUP):
    """Lists of (row, piece of its text) with about ``room`` characters each; a
    piece has up to ``SEGMENT``."""
    held, some = 0, []
    for row, text in enumerate(texts):
        text = text or ""
        for at in range(0, max(1, len(text)), SEGMENT):
            some.append((row, text[at : at + SEGMENT]))
            held += len(some[-1][1])
            if held >= room:
                yield some
                held, some = 0, []
    if some:
        yield some


def _discounts(of: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen 1-4 times."""
    n1, n2, n3, n4 = (of.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def gram_counts(trusted: DataFrame) -> DataFrame:
    """How often each four-gram is in ``trusted`` (fold, text): fold, code, n."""

    def merged(some):
        codes, place = np.unique(np.concatenate([c for c, _ in some]), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([n for _, n in some]))
        return codes, counts.astype(np.int64)

    def count(batches):
        sole_use("quality", Model._built.clear)
        held: dict[int, list] = {}
        for batch in batches:
            for fold, some in batch.groupby("fold"):
                parts = held.setdefault(fold, [])
                for part in segments(some["text"]):
                    code, _, _ = grams([text for _, text in part])
                    parts.append(np.unique(code, return_counts=True))
                    if len(parts) > 16:
                        parts[:] = [merged(parts)]
        for fold, parts in held.items():
            codes, counts = merged(parts)
            for at in range(0, len(codes), 100_000):
                cut = slice(at, at + 100_000)
                yield pd.DataFrame({"fold": fold, "code": codes[cut], "n": counts[cut]})

    counted = trusted.select("fold", "text").mapInPandas(count, "fold int, code long, n long")
    return counted.groupBy("fold", "code").agg(F.sum("n").alias("n"))


class Model:
    """The counts of a trained model; ``table`` is dense and built where needed.

    ``orders``: per order the codes seen with their discounted shares, and the
    contexts seen with the weight of the shorter gram.
    """

    _built: dict[str, np.ndarray] = {}

    def __init__(self, orders: list[tuple]):
        self.orders, self.name = orders, uuid.uuid4().hex

    def table(self) -> np.ndarray:
        """Negative log probability of every four-gram; one table per process."""
        if self.name not in self._built:
            chance = np.full(SYMBOLS, 1 / SYMBOLS, np.float32)
            for k, (codes, shares, contexts, weights) in enumerate(self.orders, 1):
                weight = np.ones((SYMBOLS ** (k - 1), 1), np.float32)
                weight[contexts, 0] = weights
                # The shorter gram of code c is c without its first symbol.
                lower = chance if k == 1 else np.tile(chance, SYMBOLS)
                lower.reshape(-1, SYMBOLS)[:] *= weight
                lower[codes] += shares
                chance = lower
            np.log(chance, out=chance)
            np.negative(chance, out=chance)
            self._built.clear()
            self._built[self.name] = chance
        return self._built[self.name]


def train(counts: DataFrame) -> Model | None:
    """Train on ``counts`` (code, n; rows of a code add up); None without any."""
    table = counts.groupBy("code").agg(F.sum("n").alias("n"))
    tables = {ORDER: stored(table, "grams")}
    for k in range(ORDER - 1, 0, -1):  # in how many contexts a shorter gram is seen
        longer = tables[k + 1]
        tables[k] = longer.groupBy((F.col("code") % SYMBOLS**k).alias("code")).agg(
            F.count("*").alias("n")
        )
    orders = []
    for k in range(1, ORDER + 1):
        grams_k = tables[k].withColumn("context", F.expr(f"code div {SYMBOLS}"))
        seen = grams_k.groupBy(F.least("n", F.lit(5)).alias("n")).count().collect()
        if not seen:
            return None
        one, two, more = _discounts({r["n"]: r["count"] for r in seen})
        cut = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
        contexts = grams_k.groupBy("context").agg(
            F.sum("n").alias("total"), F.sum(cut).alias("cut")
        )
        share = ((F.col("n") - cut) / F.col("total")).cast("float")
        rest = (F.col("cut") / F.col("total")).cast("float")
        # At most 64^k rows of two numbers, in practice the few that occur.
        rows = grams_k.join(contexts, "context").select(F.col("code").cast("int"), share.alias("p"))
        more_rows = contexts.select(F.col("context").cast("int"), rest.alias("p"))
        pair = []
        for part in (rows.toArrow(), more_rows.toArrow()):
            pair += [part.column(0).to_numpy(), part.column(1).to_numpy()]
        orders.append(tuple(pair))
    return Model(orders)
