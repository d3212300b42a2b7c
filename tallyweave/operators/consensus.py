"""What several observations of one thing agree on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def observations(df: DataFrame, key: str, fields: list[str], evidence: str) -> DataFrame:
    """(key, field, value, evidence): one row per non-blank field of each row."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value")) for f in fields))
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(evidence).alias("evidence"), F.inline(F.filter(pairs, lambda p: p["value"] != "")))


def values_seen(obs: DataFrame) -> DataFrame:
    """(key, field, value, n_seen, first_evidence), one row per distinct value; partial sums before the shuffle."""
    return obs.groupBy("key", "field", "value").agg(F.count(F.lit(1)).alias("n_seen"), F.min("evidence").alias("first_evidence"))


def consensus(obs: DataFrame) -> DataFrame:
    """(key, field, value, n_values, n_seen): the value where all observations agree, null where they differ; no winner is picked."""
    return values_seen(obs).groupBy("key", "field").agg(F.when(F.count(F.lit(1)) == 1, F.max("value")).alias("value"), F.count(F.lit(1)).alias("n_values"), F.sum("n_seen").alias("n_seen"))


def conflicts(obs: DataFrame) -> DataFrame:
    """The distinct values of fields on which observations differ, each with how often and where first it was seen."""
    seen = values_seen(obs)
    many = seen.groupBy("key", "field").agg(F.count(F.lit(1)).alias("n_values")).where("n_values > 1")
    return seen.join(many, ["key", "field"]).select("key", "field", "value", "n_seen", "first_evidence", "n_values")


def first_known(df: DataFrame, key: str, fields: list[str], order: list[str]) -> DataFrame:
    """One row per key: of each field the first non-null value in the given order of rows (which must be unique for a defined result)."""
    at = F.struct(*order)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.min_by(f, F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields))


def ranked(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group in an order: a top-k report, where k is the feature."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def complementary(df: DataFrame, by: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """df's rows clustered within each group so that rows of a cluster do not contradict its first row: (by..., cluster, fields..., n_rows).

    Rows go in order to the first cluster whose first row has, in every field, an equal value or a null on either side; a field of the
    cluster is its first non-null value. Nulls match anything, so this is no equivalence and needs the order: a group is folded in one task and
    must be small by nature (the lines of a document).
    """
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        clusters: list[list] = []
        known = [f for f in fields]
        for row in pdf.sort_values(order, kind="stable")[known].itertuples(index=False):
            row = [None if pd.isna(x) else x for x in row]
            for c in clusters:
                if all(a is None or b is None or a == b for a, b in zip(c[0], row)):
                    c[1] = [a if a is not None else b for a, b in zip(c[1], row)]
                    c[2] += 1
                    break
            else:
                clusters.append([row, list(row), 1])
        head = [pdf[b].iloc[0] for b in by]
        return pd.DataFrame([[*head, i, *c[1], c[2]] for i, c in enumerate(clusters, 1)], columns=[*by, "cluster", *fields, "n_rows"])

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"{b} {kinds[b]}" for b in by), "cluster int", *(f"{f} {kinds[f]}" for f in fields), "n_rows int"])
    return df.select(*dict.fromkeys([*by, *order, *fields])).groupBy(*by).applyInPandas(fold, schema)


def paired(left: DataFrame, right: DataFrame, by: list[str], same: list[str], order: str) -> DataFrame:
    """Greedy one-to-one pairs within each group: (by..., left_id, right_id).

    Rows of left in order each take the first free row of right that agrees in one of `same` and differs (both known) in none of them.
    A group is folded in one task and must be small by nature. Both sides carry `order` as a unique id.
    """
    def fold(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out, free = [], b.sort_values(order).to_dict("records")
        for row in a.sort_values(order).to_dict("records"):
            for other in free:
                known = [(row[f], other[f]) for f in same if not pd.isna(row[f]) and not pd.isna(other[f])]
                if known and all(x == y for x, y in known):
                    out.append([*(row[k] for k in by), row[order], other[order]])
                    free.remove(other)
                    break
        return pd.DataFrame(out, columns=[*by, "left_id", "right_id"])

    left = left.where(" and ".join(f"{k} is not null" for k in by))
    kinds = dict(left.dtypes)
    cols = list(dict.fromkeys([*by, order, *same]))
    return left.select(*cols).groupBy(*by).cogroup(right.select(*(F.col(c).alias(c) for c in cols)).groupBy(*by)).applyInPandas(fold, ", ".join([*(f"{k} {kinds[k]}" for k in by), "left_id long", "right_id long"]))



def evidence_union(df: DataFrame, key: str, ids: str) -> DataFrame:
    """(key, n_ids, ids): the distinct non-blank ids of all rows of a key, sorted; ids is a column of arrays. Ids are made distinct before they are gathered."""
    one = df.where(F.col(key).isNotNull()).select(key, F.explode(ids).alias("_id")).select(key, F.trim("_id").alias("_id")).where("_id <> ''").distinct()
    return one.groupBy(key).agg(F.count(F.lit(1)).alias("n_ids"), F.array_sort(F.collect_list("_id")).alias("ids"))


def value_evidence(obs: DataFrame) -> DataFrame:
    """(key, field, n_values, observations): fields on which observations differ, with each value and all that it was seen in: 'value<id,id>' joined by '|', sorted."""
    seen = obs.groupBy("key", "field", "value").agg(F.array_join(F.array_sort(F.collect_set("evidence")), ",").alias("ids"))
    one = F.concat("value", F.lit("<"), "ids", F.lit(">"))
    return seen.groupBy("key", "field").agg(F.count(F.lit(1)).alias("n_values"), F.array_join(F.array_sort(F.collect_list(one)), "|").alias("observations")).where("n_values > 1")


def priority_consensus(df: DataFrame, key: str, value: str, first: Column, unknown: str) -> DataFrame:
    """(key, value, n_values): what the rows of a key agree on, only those where `first` holds if there are any; `unknown` counts if nothing else was seen; `unknown` where they differ."""
    v, known = F.col(value), F.coalesce(F.col(value), F.lit(unknown)) != unknown
    seen = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_or(F.coalesce(first, F.lit(False)) & v.isNotNull()).alias("_any"), F.collect_set(F.when(known & first, v)).alias("_first"), F.collect_set(F.when(known, v)).alias("_all"))
    left = F.when(F.col("_any"), F.col("_first")).otherwise(F.col("_all"))
    return seen.select(F.col(key).alias("key"), F.when(F.size(left) == 1, F.element_at(left, 1)).otherwise(unknown).alias("value"), F.size(left).alias("n_values"))
