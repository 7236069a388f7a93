"""Operator 11: centroid clustering over subvector dictionaries.

Vectors are whole numbers.  A chunk of them is cut into blocks of neighbouring
dimensions; each block keeps its distinct subvectors (its book) once and a code
per vector, as a columnar file does with a dictionary page, so nothing is lost.
In a round the exact distances of a book's subvectors to all centroids are
computed once; a vector's distance is the sum of its codes' entries.  New
centroids come from the books as well: how often a cluster uses each code, times
the subvector.  Chunks never meet, so a round moves k rows per task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Components end at this size, so that no squared distance of up to 128
#: dimensions leaves a long.
LARGEST = 2**27
#: Vectors of a chunk, and of a slice whose distances are held at a time.
CHUNK, SLICE = 65_536, 8_192

_ENCODED = "ids array<long>, widths array<int>, books array<binary>, codes array<binary>"
_CODES = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def _narrow(codes: np.ndarray, size: int) -> np.ndarray:
    return codes.astype(np.uint8 if size <= 256 else np.uint16 if size <= 65_536 else np.uint32)


def encoded(chunk: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(book, codes) per block of dimensions of ``chunk`` (vectors x dimensions).

    Blocks start one dimension wide.  Two neighbours become one as long as that
    has at most one distinct subvector per two vectors.
    """
    n, dims = chunk.shape
    blocks = []
    for d in range(dims):
        book, codes = np.unique(chunk[:, d], return_inverse=True)
        blocks.append((book[:, None], codes.reshape(-1)))
    merged = True
    while merged:
        merged, kept, at = False, [], 0
        while at < len(blocks):
            pair = blocks[at : at + 2]
            both = None
            if len(pair) == 2 and pair[0][0].shape[1] == pair[1][0].shape[1]:
                (left, a), (right, b) = pair
                seen, codes = np.unique(a * len(right) + b, return_inverse=True)
                if 2 * len(seen) <= n:
                    parts = left[seen // len(right)], right[seen % len(right)]
                    both = np.hstack(parts), codes.reshape(-1)
            if both is not None:
                kept.append(both)
                at, merged = at + 2, True
            else:
                kept.append(pair[0])
                at += 1
        blocks = kept
    return blocks


def _encode(dims: int, chunk: int):
    def pack(ids, some):
        whole = np.concatenate(some)
        blocks = encoded(whole)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                pa.array([[b.shape[1] for b, _ in blocks]], pa.list_(pa.int32())),
                pa.array([[b.astype("<i4").tobytes() for b, _ in blocks]], pa.list_(pa.binary())),
                pa.array(
                    [[_narrow(c, len(b)).tobytes() for b, c in blocks]], pa.list_(pa.binary())
                ),
            ],
            ["ids", "widths", "books", "codes"],
        )

    def run(batches):
        ids, some, held = [], [], 0
        for batch in batches:
            keys, values = batch.column(0), batch.column(1)
            rows = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for at in range(0, len(keys), chunk):
                part = rows[at : at + chunk]
                if held + len(part) > chunk:
                    yield pack(ids, some)
                    ids, some, held = [], [], 0
                ids.append(keys.slice(at, chunk))
                some.append(part)
                held += len(part)
        if held:
            yield pack(ids, some)

    return run


def _nearest(blocks, n: int, centroids: np.ndarray):
    """Number and squared distance of the nearest centroid of each vector."""
    # Distances are whole numbers; the narrow type is used where they fit.
    reach = max([int(np.abs(b).max()) for b, _ in blocks if b.size] or [0])
    reach += int(np.abs(centroids).max())
    kind = np.int32 if reach**2 * centroids.shape[1] < 2**31 else np.int64
    tables, at = [], 0
    for book, _ in blocks:
        part = np.zeros((len(book), len(centroids)), np.int64)
        for d in range(book.shape[1]):  # one dimension of the block at a time
            part += (book[:, d, None] - centroids[None, :, at + d]) ** 2
        tables.append(part.astype(kind))
        at += book.shape[1]
    cluster, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    for low in range(0, n, SLICE):
        mine = slice(low, low + SLICE)
        total = np.zeros((min(SLICE, n - low), len(centroids)), kind)
        for table, (_, codes) in zip(tables, blocks):
            total += table.take(codes[mine], axis=0)
        cluster[mine] = total.argmin(axis=1)  # the first of equals
        distance[mine] = total[np.arange(len(total)), cluster[mine]]
    return cluster, distance


def _blocks(widths, books, codes, n: int):
    for width, book, code in zip(widths, books, codes):
        values = np.frombuffer(book, "<i4").astype(np.int64).reshape(-1, width)
        yield values, np.frombuffer(code, _CODES[len(code) // n])


def _chunks(batches):
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["ids"])
            yield row["ids"], n, list(_blocks(row["widths"], row["books"], row["codes"], n))


def _moved(centroids: np.ndarray):
    """Vectors and sums of components per cluster, one set of rows per task."""
    k, dims = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, n, blocks in _chunks(batches):
            cluster, _ = _nearest(blocks, n, centroids)
            count += np.bincount(cluster, minlength=k)
            at = 0
            for book, codes in blocks:
                uses = np.bincount(cluster * len(book) + codes, minlength=k * len(book))
                total[:, at : at + book.shape[1]] += uses.reshape(k, -1) @ book
                at += book.shape[1]
        seen = np.flatnonzero(count)
        if len(seen):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(seen, pa.int64()),
                    pa.array(count[seen]),
                    pa.array(list(total[seen]), pa.list_(pa.int64())),
                ],
                ["cluster", "n", "total"],
            )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches):
        for ids, n, blocks in _chunks(batches):
            cluster, distance = _nearest(blocks, n, centroids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return run


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id, values of the vectors that take part: floor(scale x) per component."""
    fine = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    top = F.lit(float(LARGEST))
    whole = lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), top), -top)
    return vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") == dims) & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: whole(x).cast("int")).alias("values"),
    )


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: str = "2",
    chunk: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Assignment (vec_id, cluster, distance) and centroids (cluster, n,
    inertia, values) after ``rounds`` of Lloyd's method.

    ``vectors``: vec_id, embedding; other columns are ignored.  Vectors that are
    null, of another length than ``dims``, or hold null or non-finite components
    take no part; components count as floor(``scale`` x), within plus or minus
    2^27.  The first centroids are the ``k`` vectors of least SHA-256 of
    ``seed:vec_id`` (equal ids: by components, null ids last), fewer if there
    are fewer vectors.  Equal distances go to the smaller number, a cluster
    without vectors keeps its centroid.  Each row is assigned on its own, so
    repeated rows stay.  An empty table gives two empty tables.
    """
    if dims > 128:
        raise ValueError("at most 128 dimensions")
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, dims, scale)
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(by_hash.asc_nulls_last(), "values").limit(k).collect()
    out = "vec_id long, cluster int, distance long"
    summary = "cluster int, n long, inertia long, values array<long>"
    if not first:
        return spark.createDataFrame([], out), spark.createDataFrame([], summary)
    centroids = np.array([r["values"] for r in first], np.int64)
    chunks = stored(rows.mapInArrow(_encode(dims, chunk), _ENCODED), "books")
    sums = [F.sum(F.col("total")[d]).alias(f"s{d}") for d in range(dims)]
    for _ in range(rounds):
        moved = chunks.mapInArrow(_moved(centroids), "cluster long, n long, total array<long>")
        # One row per cluster comes back, k at most.
        for r in moved.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
            centroids[r["cluster"]] = [r[f"s{d}"] // r["n"] for d in range(dims)]
    found = stored(chunks.mapInArrow(_assigned(centroids), out), "clusters")
    places = spark.createDataFrame(
        [(i, [int(x) for x in c]) for i, c in enumerate(centroids)],
        "cluster int, values array<long>",
    )
    used = found.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("inertia"))
    zero = F.lit(0).cast("long")
    final = places.join(used, "cluster", "left").select(
        "cluster",
        F.coalesce("n", zero).alias("n"),
        F.coalesce("inertia", zero).alias("inertia"),
        "values",
    )
    return found, final


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every vector of ``embeddings`` with the inertia of its cluster."""
    found, final = cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))
    rows = [  # k rows at most
        (r["cluster"], r["inertia"], hashlib.sha256(",".join(map(str, r["values"])).encode()).hexdigest())
        for r in final.collect()
    ]
    digests = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(digests), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(sum(r[1] for r in rows)).cast("long").alias("inertia"),
        "centroid_sha256",
    )


def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    """The same by plain distances, one pair of tables per round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT v.r, any_value(v.vec_id) AS vec_id,
         min({{'d': CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.e, c.e)]) AS BIGINT),
               'c': c.c}}) AS best
  FROM v CROSS JOIN c{i} c GROUP BY v.r
)""")
        if i < rounds:
            steps.append(f"""
m{i} AS MATERIALIZED (
  SELECT c, list(CAST(floor(CAST(s AS DOUBLE) / n) AS BIGINT) ORDER BY d) AS e
  FROM (SELECT a.best.c AS c, d, sum(v.e[d]) AS s, count(*) AS n
        FROM a{i} a JOIN v ON a.r = v.r, range(1, 65) t(d) GROUP BY ALL)
  GROUP BY c
), c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c
)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE len(embedding) = 64
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS INTEGER) AS c, e
  FROM v QUALIFY c < {k}
),{",".join(steps)}
SELECT a.vec_id, a.best.c AS cluster, a.best.d AS distance,
       CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.best.c = c.c
"""


OP11_SQL = _op11_sql()
