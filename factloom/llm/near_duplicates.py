"""Operator 6: near-duplicates by BagMinHash, banding and exact verification.

A document is the multiset of its runs of five words (words: runs without ASCII
white space).  The weight of a shingle is its count; the counts are discretised
at whole numbers and grouped into the dyadic ranges [0, 1), [1, 2), [2, 4), ...
Every (shingle, range) owns a Poisson process whose rate is the length of the
range; each of its points has a position in the range and one of ``REGISTERS``
registers, all fixed by hashes.  A document keeps, per register, the least point
among those whose position is below the count.  Two documents agree on a
register with the probability of their weighted Jaccard similarity.

Registers are cut into bands; documents that share a band are candidates, and a
candidate pair is a link if the multisets of the whole texts overlap enough.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import if_few, partitions, restored, shielded, sole_use, sort_key, stored

WORDS = 5
SIMILARITY = 0.8
#: A pair at 0.8 is missed by all bands with probability (1 - 0.8^5)^28 = 1.5e-5.
BANDS, ROWS = 28, 5
REGISTERS = BANDS * ROWS
#: Characters whose shingles are held at a time, about 44 bytes each.
SLICE = 300_000

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2^bits of each."""
    inverse = pow(int(_BASE), -1, 2**64)
    out = []
    for base in (int(_BASE), inverse):
        powers = np.ones(1, np.uint64)
        for i in range(bits):
            powers = np.concatenate([powers, powers * np.uint64(pow(base, 2**i, 2**64))])
        out.append(powers)
    return out[0], out[1]


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every run of ``words`` words of all texts.

    A text with fewer words, but at least one, has one shingle: all of them.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends_of = np.cumsum([len(r) + 1 for r in raw])
    power, inverse = _powers(max(20, int(len(data)).bit_length()))
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.r_[True, space]))
    starts, ends = edges[::2], edges[1::2]
    with np.errstate(over="ignore"):
        sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])
        word = sums[ends - 1] - np.where(starts > 0, sums[starts - 1], np.uint64(0))
        word = _mix(word * inverse[starts])
        owner = np.searchsorted(ends_of, starts, "right")
        count = np.bincount(owner, minlength=len(texts))
        n = max(0, len(word) - words + 1)
        run = np.zeros(n, np.uint64)
        for j in range(words):
            run = run * _BASE + word[j : j + n]
        whole = owner[:n] == owner[words - 1 : words - 1 + n]
        owners, found = [owner[:n][whole]], [_mix(run[whole])]
        for length in range(1, words):  # short texts
            at = np.flatnonzero(count == length)
            first = np.searchsorted(owner, at)
            run = np.full(len(at), length, np.uint64)
            for j in range(length):
                run = run * _BASE + word[first + j]
            owners.append(at)
            found.append(_mix(run))
    return np.concatenate(owners), np.concatenate(found)


def bags(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (owner, hash) in order, with how often each occurs."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    if not len(owner):
        return owner, hashes, np.zeros(0, np.int64)
    first = np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])]
    at = np.flatnonzero(first)
    return owner[at], hashes[at], np.diff(np.r_[at, len(owner)])


def signatures(n: int, owner, hashes, counts, registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash of ``n`` bags: an array of n rows, infinite where a bag is empty.

    All processes of all bags advance one point per round.  A process stops
    once its next point lies above every register of its bag.
    """
    least = np.full(n * registers, np.inf)
    highest = np.full(n, np.inf)
    parts, level = [], 0
    open_ = np.arange(len(owner))
    while len(open_):  # range 0 is [0, 1), range l is [2^(l-1), 2^l)
        low = 0 if level == 0 else 2 ** (level - 1)
        size = 1 if level == 0 else low
        open_ = open_[counts[open_] > low]
        seed = _mix(hashes[open_] + np.uint64((level + 1) * int(_BASE) % 2**64))
        share = (counts[open_] - low) / size
        parts.append((owner[open_], seed, share, np.full(len(open_), float(size))))
        level += 1
    if not parts:
        return least.reshape(n, registers)
    bag, seed, share, rate = (np.concatenate(x) for x in zip(*parts))
    point, step = np.zeros(len(bag)), 0
    with np.errstate(over="ignore"):
        while len(bag):
            step += 1
            one = _mix(seed + np.uint64(2 * step * int(_BASE) % 2**64))
            two = _mix(seed + np.uint64((2 * step + 1) * int(_BASE) % 2**64))
            point = point - np.log(((one >> np.uint64(11)) + 0.5) * 2.0**-53) / rate
            live = point < highest[bag]
            bag, seed, share, rate = bag[live], seed[live], share[live], rate[live]
            point, two = point[live], two[live]
            inside = ((two >> np.uint64(32)) + 0.5) * 2.0**-32 < share
            slot = bag * registers + ((two & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(least, slot[inside], point[inside])
            touched = np.unique(bag[inside])
            highest[touched] = least.reshape(n, registers)[touched].max(axis=1)
    return least.reshape(n, registers)


def band_hashes(least: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    bits = least.view(np.uint64).reshape(len(least), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for j in range(rows):
            out = _mix(out * _BASE + bits[:, :, j])
    return out.view(np.int64)


def overlap(left: tuple, right: tuple) -> float:
    """Weighted Jaccard of two bags given as (sorted hashes, counts)."""
    total = int(left[1].sum() + right[1].sum())
    _, a, b = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(left[1][a], right[1][b]).sum())
    return shared / (total - shared) if total > shared else 1.0


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    _, hashes, counts = bags(*shingles([text]))
    return hashes, counts


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (hub, other) whose whole texts overlap enough.

    ``texts``: rep, text.  Each text meets its pairs in an equi-join; the bag of
    a hub is kept while its rows follow each other.
    """
    sides = pairs.join(texts.withColumnsRenamed({"rep": "other", "text": "right"}), "other")
    sides = sides.join(texts.withColumnsRenamed({"rep": "hub", "text": "left"}), "hub")

    def check(batches):
        kept, known = None, None
        for batch in batches:
            good = []
            for hub, left, right in zip(batch["hub"], batch["left"], batch["right"]):
                if kept != hub:
                    kept, known = hub, _bag(left)
                good.append(overlap(known, _bag(right)) >= SIMILARITY)
            yield batch.loc[good, ["hub", "other"]]

    return sides.select("hub", "other", "left", "right").mapInPandas(
        check, "hub long, other long"
    )


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``rep`` and the least rep it is linked to, over any number of links.

    Every node takes the least label around it and then that label's label,
    until nothing changes; each round is a written table.
    """
    both = links.select(F.col("hub").alias("a"), F.col("other").alias("b"))
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stored(nodes.select("rep", F.col("rep").alias("label")), "labels")
    while True:
        around = (
            both.join(labels.withColumnRenamed("rep", "b"), "b")
            .groupBy(F.col("a").alias("rep"))
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(around, "rep", "left").select(
            "rep", "label", F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("rep").alias("next"), F.col("label").alias("far"))
        moved = stored(
            nearer.join(jump, "next", "left").select(
                "rep",
                F.least("next", "far").alias("label"),
                (F.least("next", "far") != F.col("label")).alias("moved"),
            ),
            "labels",
        )
        labels = moved.select("rep", "label")
        if not moved.filter("moved").head(1):
            return labels


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, rep_id, class_id and n_links.

    ``rep_id`` is the least id among documents with an equal text, ``class_id``
    the least one among all that are linked, directly or not, at a weighted
    Jaccard similarity of 0.8 or more; ``n_links`` counts the different texts
    that the document's text was linked to on the way to its class, at least one
    if it is not alone.  A null text is empty;
    all empty texts are one class.  Texts of fewer than five words are one
    shingle, so they link only to texts of the same words.  A null id counts as
    the least id and is shown as null.  Repeated rows stay; rows of one
    id are one document, so the classes of their texts are one.

    Copies are one row from the first shuffle on.  In a band with many texts,
    all are compared with one hub, the text that meets the most others over all
    bands; a band whose texts are one class by then is done.  In the others the
    texts of different classes are compared without making pairs, see ``_rest``.
    """
    spark = documents.sparkSession
    rows = documents.select(
        sort_key("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns(
        {
            "h1": F.xxhash64("text"),
            "h2": F.xxhash64("text", F.lit(1)),
        }
    )

    def sign(batches):
        sole_use("signatures")
        for batch in batches:
            # Signed by slices of so many characters; a longer text is one slice.
            sizes = batch["text"].str.len().to_numpy(np.int64)
            for _, part in batch.groupby((np.cumsum(sizes) - sizes) // SLICE, sort=False):
                owner, hashes, counts = bags(*shingles(part["text"].tolist()))
                n = len(part)
                found = band_hashes(signatures(n, owner, hashes, counts))
                filled = np.bincount(owner, minlength=n) > 0
                yield pd.DataFrame(
                    {
                        "key": part["key"],
                        "h1": part["h1"],
                        "h2": part["h2"],
                        "bands": [x if f else x[:0] for x, f in zip(found, filled)],
                    }
                )

    signed = stored(
        rows.mapInPandas(sign, "key long, h1 long, h2 long, bands array<long>"), "signed"
    )
    reps = stored(
        signed.groupBy("h1", "h2").agg(
            F.min("key").alias("rep"), F.any_value("bands").alias("bands")
        ),
        "reps",
    )
    banded = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    shared = (
        banded.groupBy("band", "hash")
        .agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("set"))
        .filter("n > 1")
        # Bands that hold the same set of texts say the same: one of them stays.
        .groupBy("n", "set")
        .agg(F.min(F.struct("band", "hash")).alias("b"))
        .select("b.band", "b.hash", "n")
    )
    shared = if_few(stored(shared, "shared"))
    members = stored(banded.join(shared, ["band", "hash"]), "members")
    weight = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    hubs = (
        members.join(weight, "rep")
        .groupBy("band", "hash")
        .agg(F.max(F.struct("weight", -F.col("rep"))).alias("top"))
        .select("band", "hash", (-F.col("top.col2")).alias("hub"))
    )
    first = stored(
        members.join(hubs, ["band", "hash"])
        .filter("rep != hub")
        .select("hub", F.col("rep").alias("other"))
        .distinct(),
        "pairs",
    )
    involved = stored(members.select("rep").distinct(), "involved")
    texts = (
        rows.join(if_few(involved), rows["key"] == involved["rep"])
        .groupBy("rep", "h1", "h2")
        .agg(F.any_value("text").alias("text"))
        .join(reps.select("rep", "h1", "h2"), ["rep", "h1", "h2"])
        .select("rep", "text")
    )
    texts = stored(texts, "texts")
    links = stored(_verified(first, texts), "links")
    labels = _components(involved, links)

    more = stored(_rest(members.join(labels, "rep"), texts), "more-links")
    if more.head(1):
        links = links.unionByName(more)
        labels = _components(involved, links)
    degree = (
        links.select(F.explode(F.array("hub", "other")).alias("rep"))
        .groupBy("rep")
        .agg(F.count("*").alias("n_links"))
    )
    classes = (
        reps.select("h1", "h2", "rep")
        .join(labels, "rep", "left")
        .join(degree, "rep", "left")
    )
    shown = lambda c: F.when(F.col(c) != -(2**63), F.col(c))
    return (
        signed.select("key", "h1", "h2")
        .join(classes, ["h1", "h2"])
        .select(
            shown("key").alias("doc_id"),
            shown("rep").alias("rep_id"),
            F.coalesce(shown("label"), shown("rep")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def _rest(members: DataFrame, texts: DataFrame, unit: int = 500) -> DataFrame:
    """Links (hub, other) between classes that meet in a band.

    ``members``: band, hash, rep, label, n.  Bands of two texts, or of one class,
    are done.  A band of n texts is cut into about n / ``unit`` parts, and every
    two parts meet in a unit of at most about 2 ``unit`` texts.  A unit counts
    shared shingles through an index and returns no more links than join its
    classes, so no table of pairs is made.
    """
    spark = members.sparkSession
    mixed = members.groupBy("band", "hash").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )
    open_ = members.filter("n > 2").join(
        mixed.filter("low != high").select("band", "hash"), ["band", "hash"]
    )
    open_ = open_.withColumn("parts", F.expr(f"int((n - 1) div {unit} + 1)"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda i: F.struct(F.least(i, part).alias("i"), F.greatest(i, part).alias("j")),
    )
    units = open_.withColumn("cell", F.explode(cells)).select(
        "rep", "label", F.xxhash64("band", "hash", "cell.i", "cell.j").alias("unit")
    )

    def link(batches):
        rows, now = [], None
        for batch in batches:
            found = []
            for key, *row in batch[["unit", "rep", "label", "text"]].itertuples(index=False):
                if key != now:
                    found += _joined(rows)
                    rows, now = [], key
                rows.append(row)
            yield pd.DataFrame(found, columns=["hub", "other"])
        yield pd.DataFrame(_joined(rows), columns=["hub", "other"])

    return (
        units.join(texts, "rep")
        .repartition(partitions(spark), "unit")
        .sortWithinPartitions("unit")
        .select("unit", "rep", "label", "text")
        .mapInPandas(link, "hub long, other long")
        .distinct()
    )


def _joined(rows: list) -> list[tuple[int, int]]:
    """Links that join classes of ``rows`` (rep, label, text), all in one band."""
    labels = [r[1] for r in rows]
    if len(set(labels)) < 2:
        return []
    bag, hashes, counts = bags(*shingles([r[2] for r in rows]))
    # The j-th occurrence of a shingle is an element of its own: then the overlap
    # of two multisets is that of two sets.
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        element = _mix(np.repeat(hashes, counts) + turn.astype(np.uint64) * _BASE)
    owner = np.repeat(bag, counts)
    sizes = np.bincount(owner, minlength=len(rows))
    _, element = np.unique(element, return_inverse=True)
    by_element = np.argsort(element, kind="stable")
    holders = owner[by_element]
    begin = np.concatenate([[0], np.cumsum(np.bincount(element))])
    first = np.concatenate([[0], np.cumsum(sizes)])
    names, root = np.unique(labels, return_inverse=True)
    largest = np.argmax(np.bincount(root))
    found = []
    for i in np.flatnonzero(root != largest):  # every pair of classes has one outside
        mine = element[first[i] : first[i + 1]]
        others = [holders[begin[e] : begin[e + 1]] for e in mine]
        if not others:
            continue
        both = np.bincount(np.concatenate(others), minlength=len(rows))
        near = (both >= SIMILARITY * (sizes + sizes[i] - both)) & (root != root[i])
        for j in np.flatnonzero(near):
            if root[j] != root[i]:
                found.append((rows[i][0], rows[j][0]))
                root[root == root[j]] = root[i]
    return found


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each class of near-duplicates, all columns.

    The document of least id stays; of several rows with that id, the one whose
    text sorts first.
    """
    classes = near_duplicates(documents).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = stored(classes.select(F.col("doc_id").alias("_id")).distinct(), "kept")
    needed = ("doc_id", "text")
    order = Window.partitionBy("doc_id").orderBy("text")
    rows = (
        shielded(documents, needed)
        .join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        .withColumn("row", F.row_number().over(order))
        .filter("row = 1")
    )
    return restored(rows, documents.columns, needed)


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
