"""A stored table that is upserted by key: bucketed files and a commit manifest.

Rows lie in a fixed number of buckets by the hash of their key.  A load reads and
rewrites only the buckets that its rows touch, under a new version; then one
small manifest, which names the version of every bucket, is committed.  Readers
take the newest manifest, so the version before stays whole until that moment
and a load that fails changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.sources.store import upsert


class Snapshots:
    """A table at ``path`` with unique ``keys``; one writer at a time.

    The buckets are given when the table is made and are the same for every
    later load: about as many as its bytes fill files.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _bucket(self) -> Column:
        # Text, so that a key of another width is the same key.
        texts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("!")) for k in self.keys]
        return F.pmod(F.xxhash64(*texts), F.lit(self.buckets)).cast("int")

    def manifest(self) -> dict[int, int]:
        """Version of each bucket in the newest committed version; at most ``buckets``."""
        try:
            every = self.spark.read.schema("bucket int, at int, v int").parquet(f"{self.path}/manifest")
        except AnalysisException:
            return {}  # no load has been committed
        newest = every.agg(F.max("v").alias("v")).first()["v"]
        if newest is None:
            return {}
        return {r["bucket"]: r["at"] for r in every.filter(F.col("v") == newest).collect()}

    def version(self) -> int:
        """Newest committed version, 0 before the first."""
        try:
            every = self.spark.read.schema("v int").parquet(f"{self.path}/manifest")
        except AnalysisException:
            return 0
        return every.agg(F.coalesce(F.max("v"), F.lit(0)).alias("v")).first()["v"]

    def read(self, only: Sequence[int] | None = None) -> DataFrame | None:
        """The newest version, or some of its buckets; None if there is nothing."""
        parts = {b: at for b, at in self.manifest().items() if only is None or b in set(only)}
        paths = [f"{self.path}/data/v={at}/bucket={b}" for b, at in sorted(parts.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def load(self, rows: DataFrame) -> int:
        """Insert or replace ``rows`` by key and commit; the new version.

        Keys that repeat in ``rows`` raise before anything is written.
        """
        repeated = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if repeated.limit(1).count():
            raise ValueError(f"keys {self.keys} repeat in the rows of a load")
        marked = rows.withColumn("_bucket", self._bucket())
        touched = sorted(r["_bucket"] for r in marked.select("_bucket").distinct().collect())
        stored, version = self.manifest(), self.version() + 1
        old = self.read([b for b in touched if b in stored])
        merged = rows if old is None else upsert(old, rows, self.keys)
        written = merged.withColumn("bucket", self._bucket()).repartition("bucket")
        written.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/v={version}")
        named = {**stored, **{b: version for b in touched}}
        manifest = self.spark.createDataFrame(sorted(named.items()) or [], "bucket int, at int")
        # Files show up here only when the job that writes them is committed.
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}")
        return version
