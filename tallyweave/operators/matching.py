"""Matching by exact keys with three outcomes: matched, ambiguous, no_match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.skew import salted_join


def signal_pairs(observed: DataFrame, master: DataFrame, signals: list[str]) -> DataFrame:
    """(obs_id, master_id, mask): pairs that share a key; bit i of mask says that signal i is equal.

    observed (obs_id, signals...) and master (master_id, signals...) hold normalised keys; null and empty ones match nothing. All signals
    go through one join; rows of hot keys are salted; a pair is one row however many keys it shares.
    """
    def long(df: DataFrame, key: str) -> DataFrame:
        rows = F.array(*(F.struct(F.lit(1 << i).alias("bit"), F.concat_ws("|", F.lit(str(i)), F.col(s)).alias("k"), F.coalesce(F.col(s), F.lit("")).alias("v")) for i, s in enumerate(signals)))
        return df.select(key, F.inline(F.filter(rows, lambda r: r["v"] != ""))).drop("v")

    right = long(master, "master_id").drop("bit").distinct()
    pairs = salted_join(long(observed, "obs_id"), right, "k", "inner", spread=F.xxhash64("obs_id"))
    return pairs.groupBy("obs_id", "master_id").agg(F.bit_or("bit").alias("mask"))


def match_by_signals(observed: DataFrame, master: DataFrame, signals: list[str]) -> DataFrame:
    """(obs_id, status, master_id, method): the outcome of each observation against all masters that share a key with it.

    If two signals each have candidates but no common one, the identity is contradictory: ambiguous 'conflicting_a_b' (the first such pair
    in the order of signals). Else the first signal with candidates decides: one is a match 'exact_s', several are 'ambiguous_s'. Without
    candidates: no_match, method 'none'. Sets are compared by counts over pairs, so no candidate list is ever gathered.
    """
    pairs = signal_pairs(observed, master, signals)
    bit = lambda i: F.col("mask").bitwiseAND(1 << i) > 0
    counts = [F.count_if(bit(i)).alias(f"_n{i}") for i in range(len(signals))]
    only = [F.min(F.when(bit(i), F.col("master_id"))).alias(f"_m{i}") for i in range(len(signals))]
    both = [(i, j, F.count_if(bit(i) & bit(j)).alias(f"_b{i}_{j}")) for i in range(len(signals)) for j in range(i + 1, len(signals))]
    per = pairs.groupBy("obs_id").agg(*counts, *only, *(b for _, _, b in both))
    joined = observed.select("obs_id").distinct().join(per, "obs_id", "left")
    clash = [(f"conflicting_{signals[i]}_{signals[j]}", (F.col(f"_n{i}") > 0) & (F.col(f"_n{j}") > 0) & (F.col(f"_b{i}_{j}") == 0)) for i, j, _ in both]
    steps: list[tuple[Column, str, Column, Column]] = [(c, "ambiguous", F.lit(None), F.lit(m)) for m, c in clash]
    for i, s in enumerate(signals):
        steps.append((F.col(f"_n{i}") == 1, "matched", F.col(f"_m{i}"), F.lit(f"exact_{s}")))
        steps.append((F.col(f"_n{i}") > 1, "ambiguous", F.lit(None), F.lit(f"ambiguous_{s}")))

    def chosen(k: int, otherwise: Column) -> Column:
        return reduce(lambda acc, st: F.when(st[0], (F.lit(st[1]), st[2], st[3])[k]).otherwise(acc), reversed(steps), otherwise)

    return joined.select("obs_id", chosen(0, F.lit("no_match")).alias("status"), chosen(1, F.lit(None).cast(master.schema["master_id"].dataType)).alias("master_id"), chosen(2, F.lit("none")).alias("method"))


def cascade(observed: DataFrame, master: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """(obs_id, status, master_id, method) by rules (method, key of observed, key of master): the first rule with candidates decides.

    One candidate: matched; several: ambiguous; none in any rule: no_match. Master rows are counted per key before they meet the
    observations, so a key shared by many costs one row. Null and empty keys match nothing.
    """
    out = observed.withColumns({f"_k{i}": key for i, (_, key, _) in enumerate(rules)}).select("obs_id", *(f"_k{i}" for i in range(len(rules))))
    for i, (_, _, key) in enumerate(rules):
        index = master.select("master_id", key.alias(f"_k{i}")).where(F.col(f"_k{i}") != "").distinct().groupBy(f"_k{i}").agg(F.count(F.lit(1)).alias(f"_n{i}"), F.min("master_id").alias(f"_m{i}"))
        out = salted_join(out, index, f"_k{i}", "left", spread=F.xxhash64("obs_id"))
    def pick(value, none: Column) -> Column:  # noqa: ANN001
        return reduce(lambda acc, i: F.when(F.col(f"_n{i}") > 0, value(i)).otherwise(acc), reversed(range(len(rules))), none)

    return out.select(
        "obs_id",
        pick(lambda i: F.when(F.col(f"_n{i}") == 1, "matched").otherwise("ambiguous"), F.lit("no_match")).alias("status"),
        pick(lambda i: F.when(F.col(f"_n{i}") == 1, F.col(f"_m{i}")), F.lit(None)).alias("master_id"),
        pick(lambda i: F.lit(rules[i][0]), F.lit("none")).alias("method"),
    )


def hierarchical(observed: DataFrame, leaves: DataFrame, leaf: str, parents: list[str]) -> DataFrame:
    """(obs_id, status, n_leaves, method) of observed (obs_id, leaf, parents...) against leaves (leaf, parents...): a leaf found by its code, held against the parents observed.

    no_match: the code is unknown. ambiguous 'conflicting_p': no leaf of that code agrees with an observed parent p (outer ones are checked
    last). matched: one leaf is left; ambiguous 'ambiguous_leaf': several. Unobserved parents (null, empty) restrict nothing.
    """
    known = leaves.select(leaf, *(F.col(p).alias(f"_{p}") for p in parents)).where(F.col(leaf) != "").distinct()
    j = salted_join(observed.select("obs_id", leaf, *parents), known.withColumn("_hit", F.lit(1)), leaf, "left", spread=F.xxhash64("obs_id"))
    ok = F.col("_hit") == 1
    counts = [F.count_if(ok).alias("_n0")]
    for i, p in enumerate(parents, 1):
        ok = ok & ((F.coalesce(F.col(p), F.lit("")) == "") | (F.col(p) == F.col(f"_{p}")))
        counts.append(F.count_if(ok).alias(f"_n{i}"))
    per = j.groupBy("obs_id").agg(*counts)
    last = F.col(f"_n{len(parents)}")
    method = F.when(F.col("_n0") == 0, "none")
    for i, p in enumerate(parents, 1):
        method = method.when(F.col(f"_n{i}") == 0, f"conflicting_{p}")
    method = method.when(last == 1, "exact_leaf").otherwise("ambiguous_leaf")
    status = F.when(F.col("_n0") == 0, "no_match").when(last == 1, "matched").otherwise("ambiguous")
    return per.select("obs_id", status.alias("status"), last.alias("n_leaves"), method.alias("method"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows share, with their number: what a validating loader refuses."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def violations(df: DataFrame, row_id: str, rules: dict[str, str]) -> DataFrame:
    """(row_id, rule): each rule (name -> SQL condition that a good row meets) that a row breaks; a null outcome counts as broken."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, c in rules.items())), lambda x: x.isNotNull())
    return df.select(row_id, F.explode(broken).alias("rule"))
