"""Filling containers of fixed capacity with whole items: non-negative least squares on the size histogram."""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.sizes import n_tokens
from tallyweave.session import cut


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """x >= 0 with least |ax - b|, by the active-set method."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    w = a.T @ (b - a @ x)
    tol = 1e-9 * max(1.0, np.abs(b).max()) * a.shape[0]
    for _ in range(rounds):
        if passive.all() or w[~passive].max() <= tol:
            break
        passive[np.argmax(np.where(passive, -np.inf, w))] = True
        while True:
            s = np.zeros(n)
            s[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            bad = passive & (s <= 0)
            if not bad.any():
                break
            step = (x[bad] / np.maximum(x[bad] - s[bad], 1e-300)).min()
            x += step * (s - x)
            passive &= x > 1e-12
            x[~passive] = 0
        x = s
        w = a.T @ (b - a @ x)
    return x


def combinations(bins: int, most: int = 3) -> list[tuple[int, ...]]:
    """All combinations of at most three bin numbers, each falling, that add up to `bins`."""
    out = [(bins,)]
    if most >= 2:
        out += [(a, bins - a) for a in range((bins + 1) // 2, bins)]
    if most >= 3:
        out += [(a, b, bins - a - b) for a in range(-(-bins // 3), bins - 1) for b in range(-(-(bins - a) // 2), min(a, bins - a - 1) + 1)]
    return out


def plan(histogram: dict[int, int], capacity: int, bins: int = 128) -> list[tuple[tuple[int, ...], int]]:
    """(sizes of the items in a container, number of such containers) for all items of the histogram (size -> count, 1..capacity).

    Sizes are grouped into at most `bins` bins. Combinations of up to three bins that fill a container are repeated as often as the
    non-negative least squares solution against the histogram says, rounded down and within what is there; long items weigh more,
    for short ones fit anywhere later. What remains is packed by size, longest first, each into the fullest container that takes
    it, gaps of the combinations included. Works on counts alone, so its cost depends on the capacity and not on the items.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    bins = min(bins, capacity)
    width = capacity / bins
    by_bin: dict[int, list[int]] = defaultdict(list)
    for s in sorted(left, reverse=True):
        by_bin[max(1, int(np.ceil(s / width - 1e-9)))].append(s)
    groups: dict[int, list[list]] = defaultdict(list)  # free room -> [sizes, containers]
    if left:
        combos = [c for c in combinations(bins) if all(b in by_bin for b in c)]
        have = np.array([sum(left[s] for s in by_bin.get(b, ())) for b in range(1, bins + 1)], float)
        weight = np.where(np.arange(1, bins + 1) * 4 > bins, 1.0, 0.1)
        if combos:
            a = np.zeros((bins, len(combos)))
            for k, c in enumerate(combos):
                for b in c:
                    a[b - 1, k] += 1
            scale = have.sum()
            repeats = nnls(a * weight[:, None], have * weight / scale) * scale
        else:
            repeats = np.zeros(0)
        for k in np.argsort(-repeats, kind="stable"):
            n = int(repeats[k])
            while n > 0:
                sizes, need = [], defaultdict(int)
                for b in combos[k]:
                    s = next((s for s in by_bin[b] if left[s] > need.get(s, 0)), None)
                    if s is None:
                        break
                    need[s] += 1
                    sizes.append(s)
                if len(sizes) < len(combos[k]):
                    break
                times = min(n, *(left[s] // m for s, m in need.items()))
                for s, m in need.items():
                    left[s] -= m * times
                groups[capacity - sum(sizes)].append([sizes, times])
                n -= times
    rooms = sorted(groups)
    for s in sorted(left, reverse=True):
        n = left[s]
        while n > 0:
            at = bisect.bisect_left(rooms, s)
            if at == len(rooms):
                m = capacity // s
                for per, times in ((m, n // m), (n % m, 1)):
                    if per and times:
                        room = capacity - per * s
                        if room not in groups or not groups[room]:
                            bisect.insort(rooms, room)
                        groups[room].append([[s] * per, times])
                n = 0
                continue
            room = rooms[at]
            sizes, times = groups[room].pop()
            used = min(times, n)
            if times > used:
                groups[room].append([sizes, times - used])
            if not groups[room]:
                rooms.pop(at)
            rest = room - s
            if not groups.get(rest):
                if rest not in rooms:
                    bisect.insort(rooms, rest)
            groups[rest].append([sizes + [s], used])
            n -= used
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for g in groups.values():
        for sizes, times in g:
            merged[tuple(sorted(sizes, reverse=True))] += times
    return sorted(merged.items(), reverse=True)


def pack(docs: DataFrame, capacity: int, salts: int = 8) -> DataFrame:
    """(doc_id, piece_no, container_no, n_tokens) of docs (doc_id, text): whole texts in containers of `capacity` tokens.

    A text above the capacity fills whole containers (piece_no 1 and up) and its rest is packed like a text; every other text has one
    row, piece_no 1. Containers are numbered from 1. Null and empty texts take no room and lie in container 1. Repeated rows are packed
    each. Only the histogram of sizes (at most `capacity` x `salts` rows, however many documents) and the plan made from it, at most a few slots per size, reach the
    driver; texts of one size are numbered in `salts` parts, so that a frequent size costs no single task.
    """
    sized = cut(docs.select("doc_id", n_tokens(F.col("text")).alias("n"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt")))
    full, rest = (F.col("n") / capacity).cast("long"), F.col("n") % capacity
    items = sized.withColumns({"full": full, "size": rest.cast("int")})
    counts = items.where("size > 0").groupBy("size", "salt").agg(F.count(F.lit(1)).alias("c")).collect()  # at most capacity x salts rows
    histogram: dict[int, int] = defaultdict(int)
    offset, seen = [], defaultdict(int)
    for r in sorted(counts):
        offset.append((r["size"], r["salt"], seen[r["size"]]))
        seen[r["size"]] += r["c"]
        histogram[r["size"]] += r["c"]
    slots, container = [], 1
    upto: dict[int, int] = defaultdict(int)
    for sizes, times in plan(histogram, capacity):
        for s in sorted(set(sizes)):
            m = sizes.count(s)
            slots.append((s, upto[s], upto[s] + m * times, container, m))
            upto[s] += m * times
        container += times
    spark = docs.sparkSession
    offsets = spark.createDataFrame(offset or [(0, 0, 0)], "size int, salt int, before long")
    table = spark.createDataFrame(slots or [(0, 0, 0, 1, 1)], "size int, lo long, hi long, first_container long, per long")
    ranked = items.where("size > 0").join(F.broadcast(offsets), ["size", "salt"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id")) - 1)
    placed = ranked.join(F.broadcast(table), "size").where("rank >= lo and rank < hi").selectExpr("doc_id", "full + 1 as piece_no", "first_container + cast((rank - lo) div per as long) as container_no", "cast(size as long) as n_tokens")
    big = items.where("full > 0").groupBy("salt").agg(F.sum("full").alias("k")).collect()
    starts, at = [], container
    for r in sorted(big):
        starts.append((r["salt"], at))
        at += r["k"]
    start = spark.createDataFrame(starts or [(0, 0)], "salt int, first long")
    before = F.sum("full").over(Window.partitionBy("salt").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1))
    whole = (
        items.where("full > 0").withColumn("before", F.coalesce(before, F.lit(0))).join(F.broadcast(start), "salt")
        .select("doc_id", F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("full"))).alias("k", "piece_no"), (F.col("first") + F.col("before")).alias("at"))
        .selectExpr("doc_id", "piece_no", "at + k as container_no", f"cast({capacity} as long) as n_tokens")
    )
    none = items.where("n = 0").selectExpr("doc_id", "1L as piece_no", "1L as container_no", "0L as n_tokens")
    return placed.unionByName(whole).unionByName(none)
