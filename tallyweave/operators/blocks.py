"""Texts as ordered blocks: ids, lexicon counts, and operators that look at neighbouring blocks of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.text import evidence_id


def blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, block_index, content, evidence_id) of docs (doc_id, text): one row per non-blank line, numbered from 0 over all lines.

    Null and empty texts give no row. Nothing is shuffled.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("block_index", "content")).where(F.trim("content") != "")
    return lines.withColumn("evidence_id", evidence_id(F.col("doc_id"), F.col("block_index"), F.lit("text"), F.col("content")))


def lexicon_counts(df: DataFrame, lexicons: dict[str, str], col: str = "content") -> DataFrame:
    """df's blocks counted per doc_id and lexicon (name -> pattern): in how many blocks the pattern occurs. One pass, partial sums before the shuffle."""
    return df.groupBy("doc_id").agg(*(F.count_if(F.col(col).rlike(p)).alias(name) for name, p in lexicons.items()))


def text_counts(docs: DataFrame, lexicons: dict[str, str]) -> DataFrame:
    """docs (doc_id, text) with the number of occurrences of each lexicon's pattern in the whole text; no shuffle."""
    return docs.select("doc_id", *(F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0)).alias(name) for name, p in lexicons.items()))


def best_class(counts: DataFrame, weights: dict[str, float], least: float) -> DataFrame:
    """(doc_id, class, score): the class of greatest weighted presence; the first named wins ties; 'unknown' below `least`."""
    scores = F.array(*(F.struct(F.when(F.col(c) > 0, w).otherwise(0.0).alias("score"), F.lit(-i).alias("rank"), F.lit(c).alias("name")) for i, (c, w) in enumerate(weights.items())))
    top = F.array_max(scores)
    return counts.select("doc_id", F.when(top["score"] >= least, top["name"]).otherwise("unknown").alias("class"), top["score"].alias("score"))


def numbered(text: str = "text") -> Column:
    """A text's non-blank lines as an array of (block_index, content), numbered from 0 over all lines."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("block_index"), x.alias("content"))), lambda b: F.trim(b["content"]) != "")


def label_values(docs: DataFrame, label: str) -> DataFrame:
    """(doc_id, block_index, label, value) of docs (doc_id, text): blocks that hold nothing but a label, with the content of the next block. No shuffle."""
    pairs = F.zip_with("b", F.slice("b", F.lit(2), F.greatest(F.size("b"), F.lit(1))), lambda x, y: F.struct(x["block_index"].alias("block_index"), F.trim(x["content"]).alias("label"), y["content"].alias("value"), x["content"].rlike(label).alias("ok")))
    found = F.filter(pairs, lambda p: p["ok"] & p["value"].isNotNull())
    return docs.where("text is not null").select("doc_id", numbered().alias("b")).select("doc_id", F.inline(F.transform(found, lambda p: F.struct(p["block_index"].alias("block_index"), p["label"].alias("label"), p["value"].alias("value")))))


def scope_filled(docs: DataFrame, headings: dict[str, str]) -> DataFrame:
    """(doc_id, block_index, content, scope) of docs (doc_id, text): the name of the last heading (name -> pattern) at or above each block, null before the first. No shuffle."""
    named = lambda x: F.coalesce(*(F.when(x["content"].rlike(p), name) for name, p in headings.items()))
    heads = F.filter(F.transform("b", lambda x: F.struct(x["block_index"].alias("at"), named(x).alias("name"))), lambda h: h["name"].isNotNull())
    df = docs.where("text is not null").select("doc_id", numbered().alias("b")).select("doc_id", "b", heads.alias("h"))
    last = lambda x: F.try_element_at(F.filter("h", lambda h: h["at"] <= x["block_index"]), F.lit(-1))["name"]
    return df.select("doc_id", F.inline(F.transform("b", lambda x: F.struct(x["block_index"].alias("block_index"), x["content"].alias("content"), last(x).alias("scope")))))


def look_ahead(docs: DataFrame, label: str, accept: str, reach: int = 5) -> DataFrame:
    """(doc_id, block_index, found_index, found) of docs (doc_id, text): for blocks that match `label`, the first of the next `reach` blocks that matches `accept`, null if none does. No shuffle."""
    df = docs.where("text is not null").select("doc_id", numbered().alias("b"))
    ahead = lambda i: F.try_element_at(F.filter(F.slice("b", i + 2, F.lit(reach)), lambda y: y["content"].rlike(accept)), F.lit(1))
    rows = F.transform("b", lambda x, i: F.when(x["content"].rlike(label), F.struct(x["block_index"].alias("block_index"), ahead(i)["block_index"].alias("found_index"), ahead(i)["content"].alias("found"))))
    return df.select("doc_id", F.inline(F.filter(rows, lambda r: r.isNotNull())))


def misses(requested: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of requested that no cached row serves: what a cache-first reader still has to compute."""
    return requested.join(cached.select(*keys).distinct(), keys, "left_anti")
