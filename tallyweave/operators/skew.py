"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: A key is hot when it holds more than 1/HOT_SHARE of all rows; there are fewer than HOT_SHARE such keys by definition.
HOT_SHARE = 64


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """Keys of more than 1/share of df's rows, fewer than `share` values whatever the size of df.

    One pass with map-side partial counts, in which all rows are counted too. Null keys never count as hot (they join nothing).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = Observation()
    top = counts.observe(total, F.sum("_n").alias("rows")).orderBy(F.desc("_n")).limit(share).collect()
    return sorted(r[0] for r in top if r[0] is not None and r[1] * share > (total.get["rows"] or 0))


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", salts: int = 32, hot: list | None = None, spread: Column | None = None) -> DataFrame:
    """big JOIN small on `key` where big may be skewed: rows of hot keys spread over `salts` copies of small's hot rows.

    how: 'left' or 'inner'. Each row of big meets exactly the rows of small that a plain join would give it.
    Only small's hot rows are repeated. spread: an expression that varies within a hot key (default: a hash of the whole row).
    """
    hot = hot_keys(big, key) if hot is None else hot
    if not hot:
        return big.join(small, key, how)
    is_hot = F.col(key).isin(hot)
    spread = F.xxhash64(*big.columns) if spread is None else spread
    left = big.withColumn("_salt", F.when(is_hot, F.pmod(spread, F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")
