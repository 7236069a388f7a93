"""Operator 5: exact top-k search by columnar branch and bound.

Vectors are packed into blocks in vertical layout, one row of a block per
dimension.  A block of queries meets a block of candidates a few dimensions at a
time, heaviest dimensions first.  After each step the Cauchy-Schwarz product of
the masses that remain bounds what a candidate can still gain; those that cannot
reach the query's current k-th score are compacted away.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions

_BLOCK = "dims int, block long, kind string, ids binary, uids binary, body binary"
#: Ties go to the smaller id; a null id is the largest.
_NULL = 2**63 - 1
#: Sums of products below this are exact in double precision.
_EXACT = 2.0**53


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows (uid, vec_id, values) as blocks of at most ``size`` vectors."""

    def pack(batches):
        made, held = 0, {}

        def block(dims, some):
            nonlocal made
            uids, ids, values = zip(*some)
            body = np.array(values, np.float64).reshape(len(some), dims).T
            kind = "<i2" if body.size and np.abs(body).max() < 2**15 else "<f8"
            number = (TaskContext.get().partitionId() << 32) + made
            made += 1
            return pd.DataFrame(
                {
                    "dims": [dims],
                    "block": [number],
                    "kind": [kind],
                    "ids": [np.array(ids, "<i8").tobytes()],
                    "uids": [np.array(uids, "<i8").tobytes()],
                    "body": [np.ascontiguousarray(body.astype(kind)).tobytes()],
                }
            )

        for batch in batches:
            for uid, key, values in zip(
                batch["uid"].tolist(), batch["key"].tolist(), batch["values"]
            ):
                some = held.setdefault(len(values), [])
                some.append((uid, key, values))
                if len(some) >= size:
                    yield block(len(values), held.pop(len(values)))
        for dims, some in held.items():
            yield block(dims, some)

    return rows.mapInPandas(pack, _BLOCK)


def _matrix(kind: str, body: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(body, kind).astype(np.float64).reshape(dims, -1)


class _Best:
    """The k best of each query of one block so far."""

    def __init__(self, ids, uids, body, k: int):
        self.ids, self.uids, self.body, self.k = ids, uids, body, k
        n = len(ids)
        self.score = [np.zeros(0)] * n
        self.key, self.who = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
        self.least = np.full(n, -np.inf)

    def add(self, i: int, score, key, who) -> None:
        score = np.concatenate([self.score[i], score])
        key = np.concatenate([self.key[i], key])
        who = np.concatenate([self.who[i], who])
        if len(score) > self.k:  # only what can be among the best is ordered
            line = np.partition(score, len(score) - self.k)[len(score) - self.k]
            near = score >= line
            score, key, who = score[near], key[near], who[near]
        order = np.lexsort((who, key, -score))[: self.k]
        self.score[i], self.key[i], self.who[i] = score[order], key[order], who[order]
        if len(order) == self.k:
            self.least[i] = self.score[i][-1]

    def rows(self) -> pd.DataFrame:
        n = [len(s) for s in self.score]
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
        return pd.DataFrame(
            {
                "query": np.repeat(self.uids, n),
                "query_id": np.repeat(self.ids, n),
                "key": join(self.key).astype(np.int64),
                "uid": join(self.who).astype(np.int64),
                "score": [int(s) for s in join(self.score)],
            }
        )


def _meet(best: _Best, ids, uids, body, step: int) -> None:
    """Offer every candidate of a block to every query of ``best``."""
    dims, n = body.shape
    queries = best.body
    top = lambda m: float(np.abs(m).max()) if m.size else 0.0
    if top(queries) * top(body) * max(dims, 1) >= _EXACT:
        whole = queries.T.astype(object).dot(body.astype(object))
        whole = np.clip(whole, -(2**63), 2**63 - 1)
        for i in range(len(best.ids)):
            other = uids != best.uids[i]
            best.add(i, whole[i][other], ids[other], uids[other])
        return
    order = np.argsort(-(body**2).sum(axis=1), kind="stable")
    cand, quer = body[order], queries[order]
    cuts = list(range(0, dims, step)) or [0]
    rest_c = [np.sqrt((cand[a + step :] ** 2).sum(axis=0)) for a in cuts]
    rest_q = [np.sqrt((quer[a + step :] ** 2).sum(axis=0)) for a in cuts]
    seed = min(n, 512)
    for low in range(0, len(best.ids), 256):  # a slice of queries at a time
        mine = slice(low, low + 256)
        first = quer[: cuts[0] + step, mine].T @ cand[: cuts[0] + step]
        for i in range(low, min(low + 256, len(best.ids))):
            partial, live = first[i - low], np.arange(n)
            if np.isneginf(best.least[i]):
                some = live[:seed][uids[:seed] != best.uids[i]]
                best.add(i, quer[:, i] @ cand[:, some], ids[some], uids[some])
                partial, live = partial[seed:], live[seed:]
            for at, a in enumerate(cuts):
                if at:
                    partial = partial + quer[a : a + step, i] @ cand[a : a + step, live]
                bound = partial + rest_q[at][i] * rest_c[at][live] * (1 + 1e-9) + 1e-6
                kept = bound >= best.least[i]
                partial, live = partial[kept], live[kept]
                if not len(live):
                    break
            other = uids[live] != best.uids[i]
            live = live[other]
            best.add(i, partial[other], ids[live], uids[live])


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, block: int = 8192, step: int = 16
) -> DataFrame:
    """The ``k`` highest inner products of each query: query_id, rank, vec_id, score.

    ``vectors``: vec_id, embedding; other columns are ignored.  Components count
    as floor(64 x).  Queries are the rows whose vec_id is a multiple of
    ``every``, candidates all rows but the query's own, by row: another row with
    the same id is a candidate.  Vectors that are null or hold null or
    non-finite components take no part, and vectors of another length than the
    query's are no candidates.  Ties go to the smaller vec_id, a null one last.
    Scores outside the range of a long are its ends.
    """
    spark = vectors.sparkSession
    fine = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"), "vec_id", "embedding"
    ).filter(F.col("embedding").isNotNull() & fine)
    rows = rows.select(
        "uid",
        F.coalesce("vec_id", F.lit(_NULL)).cast("long").alias("key"),
        F.transform(
            "embedding", lambda x: F.floor(x.cast("double") * 64).cast("double")
        ).alias("values"),
    )
    groups = partitions(spark)
    candidates = _packed(rows, block).withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups)))
    queries = _packed(rows.filter(f"key % {every} = 0 and key != {_NULL}"), block // 4).select(
        F.col("dims"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"),
        *[F.col(c).alias(f"q_{c}") for c in ("block", "kind", "ids", "uids", "body")],
    )
    pairs = queries.join(candidates, ["dims", "g"])

    def offer(batches):
        best, now = None, None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if now != r.q_block:
                    if best is not None:
                        yield best.rows()
                    now = r.q_block
                    best = _Best(
                        np.frombuffer(r.q_ids, "<i8"),
                        np.frombuffer(r.q_uids, "<i8"),
                        _matrix(r.q_kind, r.q_body, r.dims),
                        k,
                    )
                ids, uids = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.uids, "<i8")
                _meet(best, ids, uids, _matrix(r.kind, r.body, r.dims), step)
        if best is not None:
            yield best.rows()

    found = pairs.mapInPandas(
        offer, "query long, query_id long, key long, uid long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key", "uid")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(
            "query_id",
            "rank",
            F.when(F.col("key") != _NULL, F.col("key")).alias("vec_id"),
            "score",
        )
    )


def op5_exact_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(spark.read.parquet(f"{folder}/embeddings.parquet"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
