"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return
the columns of documents. run() writes each result as Parquet in the folder of
spark.checkpoint.dir and reads it again, so a stage is never made twice, and deletes the one before.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontaminate, packing, quality_rules, secret_scan, simhash_dedup
from quire.llm.common import bound_batches, materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """The stage, its batches bounded by bytes: the stages follow each other in the same executors, whose memory doesn't shrink."""

    @wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_bounded


@bounded
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


@bounded
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays, the one with the least doc_id."""
    return simhash_dedup.keep_one_similar(docs)


@bounded
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@bounded
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced."""
    return secret_scan.redact(docs)


@bounded
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in training sequences."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_dedup", keep_one_of_near_copies),
    ("decontaminate", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: SimHash fingerprints and tokenisation have no equivalent in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), replaces=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
