"""Bounded samples that do not depend on order or partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least_hashes(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The n rows of df whose key has the least hash (all, if there are no more).

    A threshold from the row count leaves about four times n rows before they are sorted, so that what tasks send on does not grow
    with their number; where it should leave too few, all rows are sorted.
    """
    total = df.count()
    ranked = df.withColumn("_h", F.xxhash64(key))
    if total > 8 * n:
        share = 4 * n / total
        below = ranked.where(F.col("_h") < F.lit(int(-(2**63) + share * 2**64)))
        if below.count() >= n:
            ranked = below
    return ranked.orderBy("_h").limit(n).drop("_h")
