"""All queries of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweave.plans import evidence, feeds, general, layouts, masters, matches, pages, texts

FAMILIES = (general, texts, layouts, masters, matches, pages, evidence, feeds)


def queries() -> dict:
    return {name: f for family in FAMILIES for name, f in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.SQL.items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return general.p6_found(spark, d)
