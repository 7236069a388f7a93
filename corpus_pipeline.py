"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
it kept and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes every stage as Parquet in the shared folder and
reads it back as the next one's input, so a lost executor costs one stage at
most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm.common import restored, shielded, small_batches, stored, table
from factloom.llm.mixing import with_copies
from factloom.llm.near_duplicates import one_of_each
from factloom.llm.packing import pack
from factloom.llm.personal_data import without_personal_data
from factloom.llm.quality import judged

#: SQL expresses neither the perplexities nor the signatures nor the packing;
#: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    small_batches(spark)
    needed = ("doc_id", "text", "lang")
    rows = judged(shielded(docs, needed), table(spark, sf_dir, "labels"))
    return restored(rows.filter("keep"), docs.columns, needed)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of least id."""
    small_batches(spark)
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    small_batches(spark)
    return without_personal_data(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources take it."""
    small_batches(spark)
    return with_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and their place in a sequence of 4096 tokens."""
    small_batches(spark)
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
