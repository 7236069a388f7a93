"""Operator 12: fill-in-middle by a Roaring-style set of unit boundaries.

The ends of a text's units (lines) are a set of code point offsets.  It is kept
in containers of 65 536 offsets each, of the smallest of three forms: an array of
low halves, a bitmap, or runs.  Cumulative cardinalities find the container of
the k-th boundary; a local select inside it gives the offset.  A text is walked
one container at a time, so only its boundaries are held.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = 65_536
#: Marks before the prefix, the suffix and the middle.
MARKS = "<P>", "<S>", "<M>"


class Boundaries:
    """A set of increasing offsets; ``select(k)`` is the k-th, from 1."""

    def __init__(self):
        self.highs: list[int] = []
        self.containers: list[tuple[str, np.ndarray, np.ndarray | None]] = []
        self.until: list[int] = []  # offsets up to and in each container

    def __len__(self) -> int:
        return self.until[-1] if self.until else 0

    def add(self, high: int, lows: np.ndarray) -> None:
        """Add the offsets ``high * SPAN + lows``; ``high`` grows from call to call."""
        if not len(lows):
            return
        starts = np.flatnonzero(np.diff(lows, prepend=-2) != 1)
        cost = {"array": 2 * len(lows), "bitmap": SPAN // 8, "run": 4 * len(starts)}
        form = min(cost, key=cost.get)
        if form == "array":
            held = lows.astype(np.uint16), None
        elif form == "bitmap":
            bits = np.zeros(SPAN, np.uint8)
            bits[lows] = 1
            packed = np.packbits(bits, bitorder="little")
            # Set bits before each run of 128 bytes.
            per = bits.reshape(-1, 1024).sum(axis=1, dtype=np.int64)
            held = packed, np.cumsum(per) - per
        else:
            sizes = np.diff(starts, append=len(lows))
            held = lows[starts].astype(np.uint16), np.cumsum(sizes) - sizes
        self.highs.append(high)
        self.containers.append((form, *held))
        self.until.append(len(self) + len(lows))

    def select(self, k: int) -> int:
        at = bisect_left(self.until, k)
        rank = k - 1 - (self.until[at - 1] if at else 0)
        form, body, before = self.containers[at]
        if form == "array":
            low = int(body[rank])
        elif form == "run":
            run = int(np.searchsorted(before, rank, "right")) - 1
            low = int(body[run]) + rank - int(before[run])
        else:
            part = int(np.searchsorted(before, rank, "right")) - 1
            bits = np.unpackbits(body[part * 128 : part * 128 + 128], bitorder="little")
            low = part * 1024 + int(np.flatnonzero(bits)[rank - int(before[part])])
        return self.highs[at] * SPAN + low


def line_ends(text: str) -> Boundaries:
    """Offsets behind the lines of ``text``; the last line may lack its break."""
    found = Boundaries()
    last = len(text)
    # Offset i is an end if character i - 1 is a break; containers hold offsets.
    for high in range(last // SPAN + 1):
        low = high * SPAN
        piece = text[max(low - 1, 0) : low + SPAN - 1]
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.flatnonzero(points == 10) + (0 if low else 1)
        if last and text[-1] != "\n" and high == last // SPAN:
            ends = np.append(ends, last - low)
        found.add(high, ends)
    return found


def cuts(texts: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
    """Lines of each text, and the offsets behind h1 % (n+1) and h2 % (n+1) of them."""
    rows = []
    for text, a, b in zip(texts, h1, h2):
        ends = line_ends(text)
        n = len(ends)
        low, high = sorted((int(a) % (n + 1), int(b) % (n + 1)))
        rows.append((n, ends.select(low) if low else 0, ends.select(high) if high else 0))
    return pd.DataFrame(rows, columns=["n", "first", "second"], dtype="int64")


def transformed(
    documents: DataFrame, seed: str = "7", percent: int = 100, spm_percent: int = 50
) -> DataFrame:
    """``documents`` with n, form, prefix, middle, suffix and output.

    ``documents``: doc_id, text and any other columns; such columns named like a
    new one or ``_h`` and ``_cut`` get a ``_`` in front.  A null text is empty and a null id
    is hashed as an empty text; rows that repeat are transformed alike.
    ``percent`` of the documents are transformed, ``spm_percent`` of these with
    the suffix first; an empty text and one that holds a mark stay plain, with
    null parts.
    """
    new = ["n", "form", "prefix", "middle", "suffix", "output", "_h", "_cut"]
    clash = [c for c in documents.columns if c in new]
    names = {c: "_" * (2 + sum(d.startswith("_") for d in clash)) + c for c in clash}
    rows = documents.withColumnsRenamed(names).withColumn("text", F.coalesce("text", F.lit("")))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    group = lambda i: F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("long")
    cut = F.pandas_udf(cuts, "n long, first long, second long")
    text = F.col("text")
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | text.contains(mark)
    form = (
        F.when((text == "") | marked | (group(2) % 100 >= percent), "plain")
        .when(group(3) % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    rows = rows.withColumn("_h", digest).withColumn("_cut", cut(text, group(0), group(1)))
    rows = rows.withColumns({"n": F.col("_cut.n"), "form": form})
    part = lambda low, size: F.when(
        F.col("form") != "plain", text.substr(low + 1, size).cast("string")
    )
    first, second = F.col("_cut.first"), F.col("_cut.second")
    whole = F.char_length(text).cast("long")
    cast = lambda x: x.cast("int")
    rows = rows.withColumns(
        {
            "prefix": part(F.lit(0), cast(first)),
            "middle": part(cast(first), cast(second - first)),
            "suffix": part(cast(second), cast(whole - second)),
        }
    )
    p, s, m = (F.lit(mark) for mark in MARKS)
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "psm", F.concat(p, "prefix", s, "suffix", m, "middle"))
        .otherwise(F.concat(s, "suffix", p, "prefix", m, "middle"))
    )
    return rows.withColumn("output", output).drop("_h", "_cut")


def restored_text(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    parts = F.split(output, "|".join(MARKS), -1)  # nothing, two outer parts, middle
    one, two, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(one, middle, two))
        .otherwise(F.concat(two, middle, one))
    )


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's form, cuts and digests."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    size = lambda c: F.char_length(c).cast("long")
    return transformed(documents).select(
        "doc_id",
        "n",
        "form",
        size("prefix").alias("prefix_chars"),
        size("middle").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_text(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), k AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT doc_id, text, n, form,
         coalesce(array_to_string(u[:least(a, b)], ''), '') AS p,
         coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
         coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS s
  FROM k
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
