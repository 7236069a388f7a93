"""Operator 4: token ids in binary shards with a minimal perfect hash index.

A shard is one row of a Parquet folder, so that Spark's own writer, commit
protocol and file system serve it: ``payload`` holds the raw ids of its
documents one after the other, ``keys`` their ids in the same order and
``index`` the minimal perfect hash that takes a document key to its place
(offset and length) in constant time, with a stored fingerprint per key that
tells foreign keys.  Shards are in ascending document order.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import block_of, if_few, new_path, null_safe_join, partitions, sort_key, stored
from .tokens import Encoder, public_path

SHARD = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("first_key", T.LongType()),
        T.StructField("last_key", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("index", T.BinaryType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_NULL = -(2**63)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: well spread, and the same on every machine."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Hash of (key, how many rows with this key came before)."""
    return _mix(_mix(keys.astype("<i8").view(np.uint64), 0) ^ repeats.astype(np.uint64), 1)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit hashes.

    Level by level each hash marks a bit among twice as many as there are
    hashes left; those alone on their bit stay, the others go on.  The rank of
    the bit is the slot.  Each slot stores a 32-bit fingerprint, the offset of
    the document's first id and its number of ids.
    """

    def __init__(self, levels, fingerprints, offsets, lengths):
        self.levels, self.fingerprints = levels, fingerprints
        self.offsets, self.lengths = offsets, lengths
        self.ranks, base = [], 0
        for bits in levels:
            inside = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
            self.ranks.append(inside[:-1] + base)
            base += int(inside[-1])

    @classmethod
    def build(cls, hashes, offsets, lengths) -> "PerfectHash":
        levels, left = [], hashes
        while len(left):
            size = 2 * len(left) + 1
            at = (_mix(left, 10 + len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        made = cls(levels, np.zeros(len(hashes), "<u4"), None, None)
        slots = made.slots(hashes)
        made.offsets = np.empty(len(hashes), "<i8")
        made.lengths = np.empty(len(hashes), "<i8")
        made.offsets[slots], made.lengths[slots] = offsets, lengths
        made.fingerprints[slots] = _fingerprint(hashes)
        return made

    def slots(self, hashes) -> np.ndarray:
        """The slot of each hash, -1 where no level has its bit."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            if not len(open_):
                break
            at = _mix(hashes[open_], 10 + level) % np.uint64(len(bits))
            at = at.astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return out

    def find(self, hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each hash is in the index, its offset and its length."""
        slots = self.slots(hashes)
        known = slots >= 0
        safe = np.where(known, slots, 0)
        if not len(self.fingerprints):
            return known, safe, safe
        known &= self.fingerprints[safe] == _fingerprint(hashes)
        return known, self.offsets[safe], self.lengths[safe]

    def dump(self) -> bytes:
        parts = [struct.pack("<II", len(self.fingerprints), len(self.levels))]
        for bits in self.levels:
            parts += [struct.pack("<I", len(bits)), np.packbits(bits).tobytes()]
        parts += [x.tobytes() for x in (self.fingerprints, self.offsets, self.lengths)]
        return b"".join(parts)

    @classmethod
    def load(cls, data: bytes) -> "PerfectHash":
        n, n_levels = struct.unpack_from("<II", data)
        at, levels = 8, []
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<I", data, at)
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at + 4)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += 4 + len(packed)
        columns = []
        for kind in ("<u4", "<i8", "<i8"):
            columns.append(np.frombuffer(data, kind, n, at))
            at += columns[-1].nbytes
        return cls(levels, *columns)


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (_mix(hashes, 2) >> np.uint64(32)).astype("<u4")


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Per row of sorted keys, how many equal keys came before it."""
    if not len(keys):
        return np.zeros(0, np.int64)
    first = np.r_[True, keys[1:] != keys[:-1]]
    starts = np.flatnonzero(first)
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.r_[starts, len(keys)]))


def _shard(part: int, number: int, keys: list[int], bodies: list[bytes]) -> dict:
    known = np.array(keys, "<i8")
    lengths = np.array([len(b) // 4 for b in bodies], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    index = PerfectHash.build(key_hash(known, _repeats(known)), offsets, lengths)
    return {
        "part": part,
        "shard": number,
        "first_key": keys[0],
        "last_key": keys[-1],
        "n_ids": int(lengths.sum()),
        "keys": known.tobytes(),
        "index": index.dump(),
        "payload": b"".join(bodies),
    }


def write_shards(
    documents: DataFrame,
    path: str,
    tokenizer: str = "byte_bpe_50k.json",
    cut: str = "byte",
    end_id: int = 0,
    shard_ids: int = 1 << 20,
) -> None:
    """Encode every ``text`` and write the shards under ``path``.

    ``documents``: ``doc_id`` and ``text``; other columns are ignored.  Each
    document's ids are followed by ``end_id``.  A null text is empty, a null id
    sorts first; rows with the same id keep a place each, ordered by text.
    Shards close once they hold ``shard_ids`` ids.  An empty table writes none.
    """
    file = public_path(tokenizer)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        encoder, part = Encoder.of(file, cut), TaskContext.get().partitionId()
        keys, bodies, held, number = [], [], 0, 0
        for batch in batches:
            found = encoder.ids(batch["text"])
            for key, ids in zip(batch["key"].tolist(), found):
                keys.append(key)
                bodies.append(ids + end)
                held += len(bodies[-1]) // 4
                if held >= shard_ids:
                    yield pd.DataFrame([_shard(part, number, keys, bodies)])
                    keys, bodies, held, number = [], [], 0, number + 1
        if keys:
            yield pd.DataFrame([_shard(part, number, keys, bodies)])

    (
        documents.select(
            sort_key("doc_id").alias("key"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        )
        .repartitionByRange(partitions(documents.sparkSession), "key")
        .sortWithinPartitions("key", "text")
        .mapInPandas(encode, SHARD)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards: ``doc_id``, ``start``, ``ids``.

    Each document is fetched by its key through the index of its shard.
    ``start`` counts the ids of all documents before it; ``ids`` is binary.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    # Two levels: few numbers per part, then one per part over all parts.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start")
    )
    inside = (
        Window.partitionBy("part")
        .orderBy("shard")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = null_safe_join(
        shards.select("part", "shard", "n_ids").withColumn(
            "inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
        ),
        parts,
        ["part"],
    ).select(
        F.col("part").alias("_part"),
        F.col("shard").alias("_shard"),
        (F.col("part_start") + F.col("inside")).alias("base"),
    )

    def fetch(batches):
        for batch in batches:
            for part, shard, keys, index, payload in zip(
                *(batch[c] for c in ("part", "shard", "keys", "index", "payload"))
            ):
                keys = np.frombuffer(keys, "<i8")
                known, offsets, lengths = PerfectHash.load(index).find(
                    key_hash(keys, _repeats(keys))
                )
                if not known.all():
                    raise ValueError(f"shard {part}/{shard}: a key is not in its index")
                for at in range(0, len(keys), 1000):
                    cut = slice(at, at + 1000)
                    yield pd.DataFrame(
                        {
                            "part": part,
                            "shard": shard,
                            "key": keys[cut],
                            "offset": offsets[cut],
                            "ids": [
                                payload[4 * a : 4 * (a + n)]
                                for a, n in zip(offsets[cut], lengths[cut])
                            ],
                        }
                    )

    rows = shards.select("part", "shard", "keys", "index", "payload").mapInPandas(
        fetch, "part int, shard int, key long, offset long, ids binary"
    )
    # One number per shard goes to the ids, which stay where they are.
    same = (F.col("part") == F.col("_part")) & (F.col("shard") == F.col("_shard"))
    return rows.join(if_few(stored(starts, "shard-starts")), same).select(
        F.when(F.col("key") != _NULL, F.col("key")).alias("doc_id"),
        (F.col("base") + F.col("offset")).alias("start"),
        "ids",
    )


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Ids of the documents named in ``wanted`` (``doc_id``); unknown ids drop.

    A key meets the shards whose key range holds it; the index of the shard
    then answers in constant time, and its fingerprint turns foreign keys away.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    # One number per part (Spark partition of the writer) comes to the driver.
    parts = shards.groupBy("part").agg(F.min("first_key").alias("k")).orderBy("k")
    firsts = parts.collect()
    numbers = F.array(*[F.lit(row["part"]) for row in firsts] or [F.lit(-1)])
    place = block_of("key", [row["k"] for row in firsts])
    keys = wanted.select(sort_key("doc_id").alias("key")).distinct()
    keys = keys.withColumn("at", place).filter("at > 0")
    keys = keys.select("key", F.element_at(numbers, F.greatest("at", F.lit(1))).alias("part"))
    inside = F.col("key").between(F.col("first_key"), F.col("last_key"))
    found = keys.join(shards.drop("keys", "index", "payload"), "part").filter(inside)
    asked = found.groupBy("part", "shard").agg(F.sort_array(F.collect_set("key")).alias("asked"))
    pairs = asked.join(shards.select("part", "shard", "index", "payload"), ["part", "shard"])

    def fetch(batches):
        for batch in batches:
            for asked, index, payload in zip(
                *(batch[c] for c in ("asked", "index", "payload"))
            ):
                keys, bodies = [], []
                found, left, again = PerfectHash.load(index), np.array(asked, "<i8"), 0
                while len(left):
                    hashes = key_hash(left, np.full(len(left), again))
                    known, at, n = found.find(hashes)
                    left, again = left[known], again + 1
                    keys += left.tolist()
                    bodies += [
                        payload[4 * a : 4 * (a + m)]
                        for a, m in zip(at[known], n[known])
                    ]
                yield pd.DataFrame({"key": keys, "ids": bodies})

    rows = pairs.select("asked", "index", "payload").mapInPandas(
        fetch, "key long, ids binary"
    )
    return rows.select(F.when(F.col("key") != _NULL, F.col("key")).alias("doc_id"), "ids")


def op4_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Write all documents as shards, read the shards back, digest per document."""
    path = new_path(spark, "token-shards")
    write_shards(spark.read.parquet(f"{folder}/documents.parquet"), path)
    return read_documents(spark, path).select(
        "doc_id",
        "start",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
