"""Queries on positioned cells: order lines laid out on a grid, one page per order. With their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators import layout as L
from tallyweave.sources.tables import table

#: x of the grid's columns: label, quantity, price.
HEADS = ((1, 40.0), (2, 200.0), (3, 320.0))
_Y = "l_linenumber * 17 + l_partkey % 9"
_X = "{x} + l_suppkey % 25"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """Three cells per line from one scan; a line's number may repeat within an order, so cells are numbered by a hash of the line."""
    key = "abs(l_partkey * 1000003 + l_suppkey * 7919 + l_linenumber * 104729 + cast(l_extendedprice * 100 as bigint)) * 3"
    one = lambda k, x: f"struct({key} + {k} as cell_id, cast({_X.format(x=x)} as double) as x, cast({_Y} as double) as y, {k} as kind, l_quantity as size)"
    return table(spark, d, "lineitem").selectExpr("l_orderkey as page_id", f"inline(array({one(0, 40)}, {one(1, 200)}, {one(2, 320)}))")


def q_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each page with the cells in them."""
    return L.rows(_cells(spark, d), 12.0).groupBy("page_id", "row_no").agg(F.count(F.lit(1)).alias("n_cells"))


def q_row_histogram(spark: SparkSession, d: str) -> DataFrame:
    return L.row_histogram(_cells(spark, d), 8.0, 3)


def q_columns(spark: SparkSession, d: str) -> DataFrame:
    """Cells per page and nearest column head."""
    cells = _cells(spark, d)
    heads = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page_id")).distinct().select("page_id", F.inline(F.array(*(F.struct(F.lit(n).alias("column_no"), F.lit(x).alias("x")) for n, x in HEADS))))
    return L.columns(cells, heads).groupBy("page_id", "column_no").agg(F.count(F.lit(1)).alias("n_cells"), F.sum("x").alias("sum_x"))


def q_nearest_right(spark: SparkSession, d: str) -> DataFrame:
    """The price nearest to each part on its right."""
    cells = _cells(spark, d)
    return L.nearest_right(cells.where("kind = 0"), cells.where("kind = 2"))


def q_nearest_unblocked(spark: SparkSession, d: str) -> DataFrame:
    """The same with no quantity above 40 between them."""
    cells = _cells(spark, d)
    return L.nearest_right(cells.where("kind = 0"), cells.where("kind = 2"), 20.0, cells.where("kind = 1 and size > 40"))


QUERIES = {f.__name__: f for f in (q_rows, q_row_histogram, q_columns, q_nearest_right, q_nearest_unblocked)}

_KEY = "abs(l_partkey * 1000003 + l_suppkey * 7919 + l_linenumber * 104729 + cast(trunc(l_extendedprice * 100) as bigint)) * 3"
_CELLS = "c as (" + " union all ".join(f"select l_orderkey as page_id, {_KEY} + {k} as cell_id, cast({_X.format(x=x)} as double) as x, cast({_Y} as double) as y, {k} as kind, l_quantity as size from lineitem" for k, x in ((0, 40), (1, 200), (2, 320))) + ")"
_LABELS = "l as (select distinct page_id, cell_id, x, y from c where kind = 0), v as (select * from c where kind = 2)"
_BEST = "select l.page_id, l.cell_id, arg_min(v.cell_id, (v.x - l.x, v.cell_id)) as value_id, min(v.x - l.x) as dx from l join v on v.page_id = l.page_id and abs(v.y - l.y) <= 20 and v.x >= l.x and v.cell_id <> l.cell_id {} group by 1, 2"
_STOP = ", s as (select l.page_id, l.cell_id, min(b.x) as stop from l join c b on b.kind = 1 and b.size > 40 and b.page_id = l.page_id and abs(b.y - l.y) <= 20 and b.x > l.x and b.cell_id <> l.cell_id group by 1, 2)"

SQL = {
    "q_row_histogram": f"with {_CELLS} select page_id, round_even(y / 8, 0) * 8 as band, count(*) as n_cells from c group by 1, 2 having count(*) >= 3",
    "q_columns": f"with {_CELLS}, n as (select page_id, x, case when abs(x - 40) <= abs(x - 200) and abs(x - 40) <= abs(x - 320) then 1 when abs(x - 200) <= abs(x - 320) then 2 else 3 end as column_no from c) select page_id, column_no, count(*) as n_cells, sum(x) as sum_x from n group by 1, 2",
    "q_nearest_right": f"with {_CELLS}, {_LABELS} {_BEST.format('')}",
    "q_nearest_unblocked": f"with {_CELLS}, {_LABELS}{_STOP} select l.page_id, l.cell_id, arg_min(v.cell_id, (v.x - l.x, v.cell_id)) as value_id, min(v.x - l.x) as dx from l join v on v.page_id = l.page_id and abs(v.y - l.y) <= 20 and v.x >= l.x and v.cell_id <> l.cell_id left join s on s.page_id = l.page_id and s.cell_id = l.cell_id where s.stop is null or s.stop >= v.x group by 1, 2",
    "q_rows": f"with recursive {_CELLS}, h as (select distinct page_id, y from c), a as (select page_id, min(y) as y from h group by 1 union all select h.page_id, min(h.y) from a join h on h.page_id = a.page_id and h.y > a.y + 12 group by h.page_id), n as (select page_id, y, row_number() over (partition by page_id order by y) as row_no from a), k as (select c.page_id, max(n.row_no) as row_no from (select row_number() over () as rowid, * from c) c join n on n.page_id = c.page_id and n.y <= c.y group by c.page_id, c.rowid) select page_id, cast(row_no as int) as row_no, count(*) as n_cells from k group by 1, 2",
}
