"""Classes of linked nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.session import cut


def classes(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) of the connected components of links (a long, b long); label is the least node of the component.

    Alternates large-star and small-star steps: each round every node links its greater (then its lesser) neighbours to its least
    one, until no link changes. Rounds grow with the logarithm of the longest chain. Nodes without links are not listed. Each round
    is written to the shared checkpoint folder. A hub's neighbours are reduced by min before the shuffle and never gathered.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(most_rounds):
        around = both(edges)
        least = around.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        edges = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    label = edges.groupBy("a").agg(F.min("b").alias("label"))
    return label.select(F.col("a").alias("node"), "label").unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
