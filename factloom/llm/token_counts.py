"""Operator 10: tokens per section from one encoding of the whole document.

A document is encoded once.  Each token covers characters [start, end) of it; an
interval join with the sections of the document, two sorted lists, gives every
token to a section.  A token that crosses a boundary is allotted by a rule:

``most``: to the section that holds most of its characters, the earlier one if
two hold as many; ``start``: to the one that holds its first character;
``split``: to each by its share of the characters.
"""

from __future__ import annotations

import re
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import Encoder, public_path

RULES = ("most", "start", "split")


class SpanEncoder(Encoder):
    """Texts to token spans; a unit's spans are kept relative to its start."""

    ROOM = 600_000
    _known: dict[tuple, "SpanEncoder"] = {}

    def spans(self, texts, step: int = 64):
        """Per text the starts and ends of its tokens, in characters."""
        texts = iter(texts)
        while units := [self.find(text) for text in islice(texts, step)]:
            known = set(chain.from_iterable(units))
            new = list(known.difference(self.memo))
            if len(self.memo) + len(new) > self.room:
                self.memo.clear()
                new = list(known)
            for at in range(0, len(new), 10_000):
                part = new[at : at + 10_000]
                for unit, one in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                    self.memo[unit] = np.array(one.offsets, "<i4").tobytes()
            for some in units:
                parts = list(map(self.memo.__getitem__, some))
                pairs = np.frombuffer(b"".join(parts), "<i4").reshape(-1, 2)
                sizes = np.fromiter(map(len, some), np.int64, len(some))
                tokens = np.fromiter(map(len, parts), np.int64, len(parts)) // 8
                base = np.repeat(np.cumsum(sizes) - sizes, tokens)
                yield pairs[:, 0] + base, pairs[:, 1] + base


def line_bounds(text: str) -> np.ndarray:
    """Bounds of the lines of ``text``, each with its line feed; they tile it."""
    cuts = [m.end() for m in re.finditer("\n", text)]
    if not cuts or cuts[-1] != len(text):
        cuts.append(len(text))
    return np.array([0, *cuts], np.int64)


def allot(starts, ends, bounds, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many tokens of it cross a boundary.

    ``bounds`` are the n + 1 bounds of n sections.  A token without characters
    belongs to the section of its position.
    """
    n = len(bounds) - 1
    inner = bounds[1:-1]
    first = np.searchsorted(inner, starts, "right")
    last = np.searchsorted(inner, np.maximum(ends - 1, starts), "right")
    crossing = first != last
    counts = np.bincount(first[~crossing], minlength=n).astype(np.float64)
    touched = np.zeros(n, np.int64)
    for a, b, s, e in zip(first[crossing], last[crossing], starts[crossing], ends[crossing]):
        held = np.minimum(bounds[a + 1 : b + 2], e) - np.maximum(bounds[a : b + 1], s)
        touched[a : b + 1] += held > 0
        if rule == "split":
            counts[a : b + 1] += held / (e - s)
        else:
            counts[a + (0 if rule == "start" else int(np.argmax(held)))] += 1
    return counts, touched


def section_tokens(
    documents: DataFrame,
    rule: str = "most",
    tokenizer: str = "byte_bpe_50k.json",
    bounds=line_bounds,
) -> DataFrame:
    """One row per section: doc_id, section, start, end, n_tokens, n_crossing.

    ``documents``: doc_id and text; other columns are ignored.  ``bounds`` maps
    a text to the bounds of its sections, which tile it; by default sections are
    lines.  ``n_tokens`` is a double, whole unless the rule is ``split``;
    ``n_crossing`` counts tokens of the section that lie in another one as well.
    A null or empty text has one empty section without tokens.  Repeated rows
    and null ids stay.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    file = public_path(tokenizer)

    def count(batches):
        encoder = SpanEncoder.of(file, "byte")
        for batch in batches:
            parts, keys = [], batch["key"].tolist()
            texts = batch["text"].tolist()
            for key, text, (starts, ends) in zip(keys, texts, encoder.spans(texts)):
                cut = bounds(text)
                counts, touched = allot(starts, ends, cut, rule)
                parts.append((key, cut[:-1], cut[1:], counts, touched))
                if len(parts) == 1000:
                    yield _frame(parts)
                    parts = []
            if parts:
                yield _frame(parts)

    return (
        documents.select(
            # As text, so that null ids pass through pandas as they are.
            F.col("doc_id").cast("string").alias("key"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .mapInPandas(
            count,
            "key string, section int, start long, end long, n_tokens double, n_crossing long",
        )
        .withColumn("doc_id", F.col("key").cast(documents.schema["doc_id"].dataType))
        .select("doc_id", "section", "start", "end", "n_tokens", "n_crossing")
    )


def _frame(parts: list[tuple]) -> pd.DataFrame:
    sizes = [len(p[1]) for p in parts]
    join = lambda i: np.concatenate([p[i] for p in parts])
    return pd.DataFrame(
        {
            "key": np.repeat(np.array([p[0] for p in parts], object), sizes),
            "section": np.concatenate([np.arange(n) for n in sizes]),
            "start": join(1),
            "end": join(2),
            "n_tokens": join(3),
            "n_crossing": join(4),
        }
    )


def op10_section_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document."""
    found = section_tokens(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.withColumn("n_tokens", F.col("n_tokens").cast("long"))
