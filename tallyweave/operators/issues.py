"""Findings about records: rules with a severity, their order, filters, counts and what follows for the record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Severities from the gravest, with what a record becomes by its gravest finding.
SEVERITIES = {"BLOCKING": "BLOCKED", "ERROR": "INVALID", "WARNING": "WARNING", "INFO": "VALID"}


@dataclass(frozen=True)
class Check:
    """A finding where `when` (SQL) holds. ends: records it is found in are asked nothing further."""

    code: str
    severity: str
    field: str
    when: str
    ends: bool = False


def issues(df: DataFrame, key: str, checks: list[Check]) -> DataFrame:
    """(key, code, severity, rank, field, place): one row per finding; place numbers a record's findings in the order of the checks. Nothing is shuffled."""
    found, over = [], F.lit(False)
    for i, c in enumerate(checks):
        here = F.coalesce(F.expr(c.when), F.lit(False)) & ~over
        found.append(F.when(here, F.struct(F.lit(c.code).alias("code"), F.lit(c.severity).alias("severity"), F.lit(list(SEVERITIES).index(c.severity)).alias("rank"), F.lit(c.field).alias("field"), F.lit(i).alias("place"))))
        if c.ends:
            over = over | here
    return df.select(key, F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


def ordered(found: DataFrame, by: list[str]) -> DataFrame:
    """found with `position`: its place in the order of field, gravity, code and check among the findings of the same key."""
    from pyspark.sql import Window

    return found.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy("field", "rank", "code", "place")))


def verdicts(df: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """(key, status, n_blocking, n_error, n_warning, n_info) of every record of df, also of those without findings."""
    counts = found.groupBy(key).agg(F.min("rank").alias("_worst"), *(F.count_if(F.col("severity") == s).alias(f"n_{s.lower()}") for s in SEVERITIES))
    status = F.element_at(F.array(*(F.lit(x) for x in SEVERITIES.values())), F.coalesce("_worst", F.lit(len(SEVERITIES) - 1)) + 1)
    return df.select(key).join(counts, key, "left").select(key, status.alias("status"), *(F.coalesce(f"n_{s.lower()}", F.lit(0)).alias(f"n_{s.lower()}") for s in SEVERITIES))
