"""Positioned text: rows, columns and nearest neighbours on a page. Cells are (page_id, cell_id, x, y, content)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows(cells: DataFrame, tolerance: float = 12.0) -> DataFrame:
    """(page_id, cell_id, row_no): cells from top to bottom; a new row begins where y is more than `tolerance` away from the row's first cell.

    The rule depends on each row's anchor, so the distinct heights of a page, few beside its cells, are folded in order to the heights at which rows begin; a
    cell lies in the row of the last such height above it.
    Cells with a null y give no row.
    """
    heights = F.array_sort(F.collect_set("y"))
    starts = F.aggregate(heights, F.expr("cast(array() as array<double>)"), lambda acc, y: F.when((F.size(acc) == 0) | (y - F.try_element_at(acc, F.lit(-1)) > tolerance), F.concat(acc, F.array(y))).otherwise(acc))
    known = cells.where("y is not null").select("page_id", "cell_id", F.col("y").cast("double").alias("y"))
    pages = known.groupBy("page_id").agg(starts.alias("_starts"))
    return known.join(pages, "page_id").select("page_id", "cell_id", F.size(F.filter("_starts", lambda s: s <= F.col("y"))).alias("row_no"))


def row_histogram(cells: DataFrame, step: float = 8.0, least: int = 1) -> DataFrame:
    """(page_id, band, n_cells): cells per horizontal band of `step`, half-even rounded; bands of fewer than `least` are left out."""
    return cells.groupBy("page_id", (F.bround(F.col("y") / step) * step).alias("band")).agg(F.count(F.lit(1)).alias("n_cells")).where(F.col("n_cells") >= least)


def columns(cells: DataFrame, heads: DataFrame) -> DataFrame:
    """cells with the column whose head (page_id, column_no, x) is nearest in x, the left one on ties; null on pages without heads.

    A page's heads are one small array, so cells meet them by page and look up their interval there.
    """
    mids = heads.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("x", "column_no"))).alias("_heads"))
    nearest = F.array_min(F.transform("_heads", lambda h: F.struct(F.abs(h["x"] - F.col("x")).alias("d"), h["x"].alias("hx"), h["column_no"].alias("column_no"))))
    return cells.join(mids, "page_id", "left").withColumn("column_no", nearest["column_no"]).drop("_heads")


def nearest_right(labels: DataFrame, values: DataFrame, band: float = 20.0, blockers: DataFrame | None = None) -> DataFrame:
    """(page_id, cell_id, value_id, dx): for each label the nearest value to its right on its line (|dy| <= band), the lower id on ties.

    Equi-join on page and bands of y: each label looks into its own band and both neighbours, so no page is paired with itself whole. With
    blockers, a value with a blocker between it and the label does not count.
    """
    def banded(df: DataFrame, p: str) -> DataFrame:
        return df.select("page_id", F.col("cell_id").alias(f"{p}id"), F.col("x").alias(f"{p}x"), F.col("y").alias(f"{p}y"), F.floor(F.col("y") / band).alias("_band"))

    left = banded(labels, "l_").withColumn("_band", F.explode(F.array(*(F.col("_band") + k for k in (-1, 0, 1)))))
    near = lambda a, b: (F.abs(F.col(f"{a}y") - F.col(f"{b}y")) <= band)
    pairs = left.join(banded(values, "v_"), ["page_id", "_band"]).where(near("l_", "v_") & (F.col("v_x") >= F.col("l_x")) & (F.col("v_id") != F.col("l_id")))
    if blockers is not None:
        stop = left.join(banded(blockers, "b_"), ["page_id", "_band"]).where(near("l_", "b_") & (F.col("b_x") > F.col("l_x")) & (F.col("b_id") != F.col("l_id"))).groupBy("page_id", "l_id").agg(F.min("b_x").alias("_stop"))
        pairs = pairs.join(stop, ["page_id", "l_id"], "left").where(F.col("_stop").isNull() | (F.col("_stop") >= F.col("v_x")))
    best = pairs.groupBy("page_id", "l_id").agg(F.min(F.struct((F.col("v_x") - F.col("l_x")).alias("dx"), F.col("v_id").alias("value_id"))).alias("m"))
    return best.select("page_id", F.col("l_id").alias("cell_id"), "m.value_id", "m.dx")


def x_buckets(cells: DataFrame, width: float) -> DataFrame:
    """(page_id, cell_id, bucket): cells from left to right; a new bucket begins where x is more than `width` away from the bucket's first cell."""
    turned = cells.select("page_id", "cell_id", F.col("y").alias("x"), F.col("x").alias("y"))
    return rows(turned, width).withColumnRenamed("row_no", "bucket")
