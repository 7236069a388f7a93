"""Session settings the operators rely on; all are runtime SQL settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Adaptive execution sizes partitions, picks broadcast joins from measured
    # sizes and splits the partitions of hot join keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even when the split costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def spread(rows: DataFrame) -> DataFrame:
    """Use every core on a small input that arrives in fewer partitions.

    Large inputs have more splits than there are cores and stay as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Shared folder named by the cluster, null where none is set."""
    return spark.conf.get("spark.checkpoint.dir", None)


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a new folder that every executor can reach.

    Under the cluster's shared folder; where none is set, which only a local
    session may do, under a temporary one that goes when Python ends.
    """
    shared = checkpoint_dir(spark)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        shared = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/factloom/{label}-{uuid.uuid4().hex}"


def materialise(rows: DataFrame, label: str) -> DataFrame:
    """Write a table that several outputs share once, and read it back.

    The written copy is in the cluster's shared folder, so lost executors do
    not lose it.  Without such a folder the rows stay lazy and are recomputed.
    """
    return rows if checkpoint_dir(rows.sparkSession) is None else store(rows, label)


def store(rows: DataFrame, label: str) -> DataFrame:
    """Write a table now and read it back, so that all its uses see the same rows."""
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
