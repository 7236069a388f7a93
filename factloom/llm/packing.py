"""Operator 8: best-fit packing by minimum bin slack.

How documents are packed depends on their lengths only, and a length is at most
the size of a sequence.  So the packing is solved on the table (length, count):
the longest length left opens a bin, a bitset subset-sum over the lengths left
finds the fullest combination for the rest, and that bin is taken as often as
the counts allow.  Every step uses up a length or one of its multiples, so the
number of patterns is bounded by the size of a sequence, never by the number of
documents.  The pieces are then numbered within their length and dealt to the
patterns.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, null_safe_join, sort_key, stored
from .tokens import Encoder, public_path


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Lengths, repeats allowed up to their counts, whose sum is nearest to ``room``.

    ``lengths`` are descending.  Bit i of ``reach`` says that the sum i can be
    made; each step keeps the bits before it, so that the choice can be read
    back.  The search ends early once ``room`` itself is reached.
    """
    limit = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        left = min(counts[length], room // length)
        times = 1
        while left > 0:  # powers of two make every number of repeats
            times = min(times, left)
            steps.append((length * times, length, times, reach))
            reach |= (reach << (length * times)) & limit
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = []
    for weight, length, times, before in reversed(steps):
        if before >> total & 1:
            continue
        chosen += [length] * times
        total -= weight
    return chosen


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """(how often, {length: pieces in the bin}) until no length is left."""
    counts = {k: n for k, n in histogram.items() if n > 0}
    lengths = sorted(counts, reverse=True)
    made = []
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        chosen = fullest(lengths, counts, size - first)
        counts[first] += 1
        used: dict[int, int] = {first: 1}
        for length in chosen:
            used[length] = used.get(length, 0) + 1
        often = min(counts[k] // n for k, n in used.items())
        for k, n in used.items():
            counts[k] -= often * n
            if not counts[k]:
                del counts[k]
                lengths.remove(k)
        made.append((often, used))
    return made


def plan_table(histogram: dict[int, int], size: int) -> pd.DataFrame:
    """Per length and pattern: which ranks go there, and where they lie."""
    rows, ranks, sequence = [], {}, 0
    for often, used in patterns(histogram, size):
        offset = 0
        for length, n in used.items():
            start = ranks.get(length, 0)
            rows.append((length, start, n, sequence, offset))
            ranks[length] = start + often * n
            offset += length * n
        sequence += often
    names = ["length", "first_rank", "in_bin", "first_sequence", "first_offset"]
    return pd.DataFrame(rows, columns=names).sort_values(["length", "first_rank"])


def pieces_of(
    documents: DataFrame, tokenizer: str, cut: str, end_id: int, size: int
) -> DataFrame:
    """Encode every text, add ``end_id`` and cut what is longer than ``size``."""
    file = public_path(tokenizer)
    end = struct.pack("<I", end_id)

    def encode(batches):
        encoder = Encoder.of(file, cut)
        for batch in batches:
            rows = []
            for uid, key, ids in zip(
                batch["uid"].tolist(), batch["key"].tolist(), encoder.ids(batch["text"])
            ):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    body = ids[at : at + 4 * size]
                    rows.append((uid, key, piece, at // 4, len(body) // 4, body))
            yield pd.DataFrame(rows, columns=["uid", "key", "piece", "start", "length", "ids"])

    return documents.select(
        F.monotonically_increasing_id().alias("uid"),
        sort_key("doc_id").alias("key"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).mapInPandas(
        encode, "uid long, key long, piece int, start long, length int, ids binary"
    )


def pack(
    documents: DataFrame,
    size: int = 4096,
    tokenizer: str = "word_bpe_49k.json",
    cut: str = "word",
    end_id: int = 1,
) -> DataFrame:
    """Pieces of all documents with their ids and their place in a sequence.

    ``documents``: ``doc_id`` and ``text``; other columns are ignored.  Returns
    doc_id, piece, start, length, ids (little-endian unsigned 32-bit),
    sequence_id and offset.  A null text is empty and gives one piece, its end
    id.  Repeated rows are packed each.  An empty table gives no rows.
    """
    spark = documents.sparkSession
    pieces = stored(pieces_of(documents, tokenizer, cut, end_id, size), "pieces")
    histogram = {  # at most ``size`` rows
        r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()
    }
    plan = plan_table(histogram, size)
    # Bounded by ``size`` times its logarithm, whatever the input.
    shared = spark.sparkContext.broadcast(plan.to_numpy(np.int64))

    def place(batches):
        table = shared.value
        # A rank lies in the last row of its length that begins at or below it.
        starts = table[:, 0] * (1 << 44) + table[:, 1]
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            rank = batch["rank"].to_numpy(np.int64)
            row = table[np.searchsorted(starts, length * (1 << 44) + rank, "right") - 1]
            copy, within = np.divmod(rank - row[:, 1], row[:, 2])
            yield pd.DataFrame(
                {
                    "uid": batch["uid"],
                    "piece": batch["piece"],
                    "sequence_id": row[:, 3] + copy,
                    "offset": row[:, 4] + within * length,
                }
            )

    ranked = numbered(pieces.select("uid", "piece", "length"), ["length"], ["uid", "piece"])
    placed = ranked.select("uid", "piece", "length", "rank").mapInPandas(
        place, "uid long, piece int, sequence_id long, offset long"
    )
    return null_safe_join(pieces, placed, ["uid", "piece"]).select(
        F.when(F.col("key") != -(2**63), F.col("key")).alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids",
        "sequence_id",
        "offset",
    )


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens; the ids as a digest."""
    return digest(pack(spark.read.parquet(f"{folder}/documents.parquet")))


def digest(packed: DataFrame) -> DataFrame:
    return packed.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
