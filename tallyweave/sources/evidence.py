"""Evidence from native text, recognition and vision answers in one shape, and where each page's text comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.text import evidence_id, n_letters

#: Columns of evidence: a box is null where the source has none.
COLUMNS = ("doc_id", "page", "block_index", "content", "confidence", "x0", "y0", "x1", "y1", "source", "evidence_id")


def _shaped(df: DataFrame, source: str, confidence: Column, box: list[Column]) -> DataFrame:
    """df (doc_id, page, block_index, content) in the shape of evidence; blank contents give no row."""
    df = df.where(F.trim("content") != "").select("doc_id", F.col("page").cast("int").alias("page"), F.col("block_index").cast("int").alias("block_index"), "content", confidence.cast("double").alias("confidence"), *(c.cast("double").alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"))), F.lit(source).alias("source"))
    return df.withColumn("evidence_id", evidence_id(F.concat_ws("#", F.col("doc_id").cast("string"), "page"), F.col("block_index"), F.col("source"), F.col("content")))


def native_pages(pages: DataFrame, least: int = 20) -> DataFrame:
    """pages (doc_id, page, text) with `n_letters` and `kind`: 'native' if a page has at least `least` characters that are no white space, else 'image'; null texts have none."""
    n = F.coalesce(n_letters(F.col("text")), F.lit(0))
    return pages.withColumns({"n_letters": n, "kind": F.when(n >= least, "native").otherwise("image")})


def from_native(pages: DataFrame) -> DataFrame:
    """Evidence of native pages (doc_id, page, text): one row per line, without confidence or box."""
    lines = pages.where("text is not null").select("doc_id", "page", F.posexplode(F.split("text", "\n")).alias("block_index", "content"))
    return _shaped(lines, "native", F.lit(None), [F.lit(None)] * 4)


def from_recognition(blocks: DataFrame) -> DataFrame:
    """Evidence of recognised blocks (doc_id, page, block_index, content, confidence, polygon array<array<double>>): the box spans the polygon."""
    at = lambda k, f: f(F.transform("polygon", lambda p: p[k]))
    return _shaped(blocks, "ocr", F.col("confidence"), [F.bround(at(0, F.array_min)), F.bround(at(1, F.array_min)), F.bround(at(0, F.array_max)), F.bround(at(1, F.array_max))])


def from_vision(answers: DataFrame) -> DataFrame:
    """Evidence of vision answers (doc_id, page, answer, ok): one row per line of each answer that came; a model's own certainty is not taken for confidence."""
    lines = answers.where("ok and answer is not null").select("doc_id", "page", F.posexplode(F.split("answer", "\n")).alias("block_index", "content"))
    return _shaped(lines, "vision", F.lit(None), [F.lit(None)] * 4)


def acquired(wanted: DataFrame, cached: DataFrame, read: DataFrame, keys: list[str]) -> DataFrame:
    """Cached rows of the wanted pages, and for pages that the cache lacks those just read, with `origin`; `read` is only evaluated for misses."""
    hits = cached.join(wanted.select(*keys).distinct(), keys, "left_semi").withColumn("origin", F.lit("cache"))
    misses = wanted.select(*keys).distinct().join(cached.select(*keys).distinct(), keys, "left_anti")
    return hits.unionByName(read.join(misses, keys, "left_semi").withColumn("origin", F.lit("read")))


def models_for(pages: DataFrame, models: dict[str, str], fallback: str) -> DataFrame:
    """pages with `model`: that of their language (codes and regions alike), else the fallback; the list is small and becomes one expression."""
    code = F.lower(F.regexp_extract(F.coalesce("language", F.lit("")), r"^\s*([A-Za-z]{2})", 1))
    lookup = F.create_map(*(F.lit(x) for pair in models.items() for x in pair))
    return pages.withColumn("model", F.coalesce(lookup[code], F.lit(fallback)))


def image_paths(pages: DataFrame, known: DataFrame) -> DataFrame:
    """pages (doc_id, page, path) with the path that exists in known (path): as given, or with 'page-001' and 'page_001' exchanged; null if neither does."""
    other = F.when(F.col("path").contains("page-"), F.replace("path", F.lit("page-"), F.lit("page_"))).otherwise(F.replace("path", F.lit("page_"), F.lit("page-")))
    there = known.select("path").distinct()
    df = pages.withColumn("_other", other)
    df = df.join(there.select("path", F.lit(True).alias("_a")), "path", "left").join(there.select(F.col("path").alias("_other"), F.lit(True).alias("_b")), "_other", "left")
    return df.withColumn("path", F.when(F.col("_a"), F.col("path")).when(F.col("_b"), F.col("_other"))).drop("_other", "_a", "_b")
