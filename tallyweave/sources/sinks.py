"""Writers and the frames that they write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def envelopes(files: DataFrame, accepted: DataFrame, declined: DataFrame) -> DataFrame:
    """(file, body): one JSON text {file, payables, declined} per file, empty lists where it has none.

    accepted and declined carry `file` and any columns; the lists are ordered by their JSON text, so the result does not depend on partitions.
    """
    def listed(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c != "file"]
        return df.groupBy("file").agg(F.array_sort(F.collect_list(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}))).alias(name))

    text = lambda c: F.concat(F.lit("["), F.coalesce(F.array_join(c, ","), F.lit("")), F.lit("]"))
    j = files.select("file").distinct().join(listed(accepted, "payables"), "file", "left").join(listed(declined, "declined"), "file", "left")
    name = F.regexp_extract(F.to_json(F.struct("file")), r"^\{\"file\":(.*)\}$", 1)
    return j.select("file", F.concat(F.lit('{"file":'), name, F.lit(',"payables":'), text("payables"), F.lit(',"declined":'), text("declined"), F.lit("}")).alias("body"))


def write_envelopes(df: DataFrame, path: str) -> None:
    """Write envelopes as JSON lines in parallel."""
    df.select(F.col("body").alias("value")).write.mode("overwrite").text(path)


def flat_csv(df: DataFrame, cut_at: int = 200) -> DataFrame:
    """df for a CSV file: lists joined by '|', long date lists cut as the format asks."""
    cols = []
    for name, kind in df.dtypes:
        c = F.concat_ws("|", F.transform(name, lambda x: x.cast("string"))) if kind.startswith("array") else F.col(name)
        cols.append((F.substring(c, 1, cut_at) if name.startswith("date") and kind.startswith("array") else c).alias(name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    flat_csv(df).write.mode("overwrite").option("header", True).csv(path)


def manifest(evidence: DataFrame, by: str = "doc_id") -> DataFrame:
    """Blocks, letters and confidences per document, with the whole as one more row (null document)."""
    return evidence.rollup(by).agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum(F.length("content")).alias("n_chars"), F.avg("confidence").alias("mean_confidence"), F.min("confidence").alias("least"), F.max("confidence").alias("greatest"), F.avg(F.when(F.col("confidence") < 0.7, 1.0).otherwise(0.0)).alias("low_share")
    )


def markdown(summary: DataFrame, title: str, most: int = 200) -> str:
    """A small summary as a Markdown table; refuses a frame of more than `most` rows."""
    rows = summary.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report holds at most {most} rows")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([f"# {title}", "", line(summary.columns), line(["---"] * len(summary.columns)), *(line(r) for r in rows), ""])


def write_each(df: DataFrame, path: str) -> None:
    """Write envelopes (file, body) in parallel, each file's own in a folder of its name: path/file=<name>/."""
    df.select("file", F.col("body").alias("value")).repartition("file").write.mode("overwrite").partitionBy("file").text(path)


def render_manifest(images: DataFrame) -> DataFrame:
    """(path, n_pages, n_failed, n_bytes, n_pixels) of rendered pages (see providers.rendered) per file, with all of them as one more row (null path)."""
    ok = F.col("status") == "success"
    return images.rollup("path").agg(F.count_if(ok).alias("n_pages"), F.count_if(~ok).alias("n_failed"), F.sum(F.when(ok, F.length("image"))).alias("n_bytes"), F.sum(F.when(ok, F.col("width") * F.col("height"))).cast("long").alias("n_pixels"))


def write_report(df: DataFrame, path: str) -> None:
    """An inventory as JSON lines, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
