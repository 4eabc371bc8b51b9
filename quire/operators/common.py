"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over all shuffle partitions, for row work that costs far more than its bytes suggest.

    A number of partitions that is asked for isn't merged by adaptive execution. The hash of the keys stands for
    them, as Catalyst drops a repartition by keys that a join or aggregation has dealt by already.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*keys))
