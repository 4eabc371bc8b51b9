"""Confidence gates for pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.75


def signal(rec_score: Column, logprob_mean: Column) -> Column:
    """The recognition score, else the mean log-probability, else null."""
    return F.coalesce(rec_score, logprob_mean)


def gate(elements: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, page, min_signal, below, passed): a page fails if a signal is below the threshold; no signal passes.

    elements: doc_id, page, id, signal.
    """
    low = F.array_sort(F.collect_list(F.when(F.col("signal") < threshold, F.col("id"))))
    out = elements.groupBy("doc_id", "page").agg(F.min("signal").alias("min_signal"), low.alias("below"))
    return out.withColumn("passed", F.size("below") == 0)
