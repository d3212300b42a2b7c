"""Readers of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweave.session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table folder/name.parquet (one file or a directory of files)."""
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
