"""Queries p2, p3 and p6 on packed fields, orphan references and nested records, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators import nested
from tallyweave.operators.orphans import OrphanState, step
from tallyweave.operators.packed import split_packed
from tallyweave.sources.tables import table

PACKED = {"currency_candidates": "currency", "invoice_number_candidates": "number", "date_candidates": "date"}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(table(spark, d, "document_inventory"), "inventory_id", PACKED)


def p2_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each value stands at each position."""
    return p2_found(spark, d).groupBy("field_name", "item_pos").agg(F.count(F.lit(1)).alias("n_values"), F.countDistinct("item_value").alias("n_distinct"))


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "po_master").select(F.col("po_row_id").alias("ref_id"), F.col("supplier_id").alias("ref_key"), F.col("created_at").alias("ref_at"))


def _parents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "suppliers").select(F.col("supplier_row_id").alias("parent_id"), F.col("supplier_id").alias("ref_key"), F.col("loaded_at").alias("valid_from"), F.col("deleted_at").alias("valid_to"))


def _replayed(spark: SparkSession, d: str) -> OrphanState:
    """The state after two batches in the order of arrival: what was loaded in the first half of the time, then the rest with the deletions of that time."""
    orders, suppliers = table(spark, d, "po_master"), table(spark, d, "suppliers")
    half = orders.agg(F.percentile_approx(F.unix_micros(F.col("loaded_at").cast("timestamp")), 0.5)).first()[0] or 0
    early = lambda c: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")) <= half, F.lit(False))
    refs = lambda when: orders.where(when).select(F.col("po_row_id").alias("ref_id"), F.col("supplier_id").alias("ref_key"), F.col("created_at").alias("ref_at"))
    until = F.when(early("deleted_at"), F.col("deleted_at"))
    parents = lambda when, to: suppliers.where(when).select(F.col("supplier_row_id").alias("parent_id"), F.col("supplier_id").alias("ref_key"), F.col("loaded_at").alias("valid_from"), to.alias("valid_to"))
    state = step(OrphanState.new(spark, buckets=8), refs(early("loaded_at")), parents(early("loaded_at"), until))
    changed = ~early("loaded_at") | (F.col("deleted_at").isNotNull() & ~early("deleted_at"))
    return step(state, refs(~early("loaded_at")), parents(changed, F.col("deleted_at")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _replayed(spark, d).orphans().select(F.col("ref_id").alias("po_row_id"), F.date_format("ref_at", "yyyy-MM").alias("po_month"), "reason")


def p3_monthly(spark: SparkSession, d: str) -> DataFrame:
    return _replayed(spark, d).snapshot("po_master")


def p3_replayed(spark: SparkSession, d: str) -> DataFrame:
    """Orders first, then the suppliers as they were registered, then their deletions: three batches on one state."""
    parents = _parents(spark, d)
    state = step(OrphanState.new(spark, buckets=8), new_refs=_refs(spark, d))
    state = step(state, new_parents=parents.withColumn("valid_to", F.lit(None).cast("timestamp_ntz")))
    return step(state, new_parents=parents.where("valid_to is not null")).snapshot("po_master")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.nodes(table(spark, d, "chart_of_books"), table(spark, d, "po_master"), table(spark, d, "master_feed"))


def p6_order_lines(spark: SparkSession, d: str) -> DataFrame:
    return nested.order_lines(table(spark, d, "po_master"))


def p6_orders(spark: SparkSession, d: str) -> DataFrame:
    return nested.orders(table(spark, d, "po_master"))


def p6_companies(spark: SparkSession, d: str) -> DataFrame:
    return nested.companies(table(spark, d, "chart_of_books"))


def p6_units(spark: SparkSession, d: str) -> DataFrame:
    return nested.units(table(spark, d, "chart_of_books"))


def p6_locations(spark: SparkSession, d: str) -> DataFrame:
    return nested.locations(table(spark, d, "chart_of_books"))


def p6_feed_orders(spark: SparkSession, d: str) -> DataFrame:
    return nested.feed_orders(table(spark, d, "master_feed"))


QUERIES = {f.__name__: f for f in (p2_found, p2_value_counts, p3_found, p3_monthly, p3_replayed, p6_found, p6_order_lines, p6_orders, p6_companies, p6_units, p6_locations, p6_feed_orders)}

_ORPHANS = r"""
with o as (select po_row_id, created_at, regexp_replace(supplier_id, '^[\s\pZ]+|[\s\pZ]+$', '', 'g') as id from po_master),
x as (select o.po_row_id, o.created_at, count(p.supplier_row_id) as n, count(*) filter (p.loaded_at <= o.created_at) as known,
        count(*) filter (p.loaded_at <= o.created_at and (p.deleted_at is null or p.deleted_at > o.created_at)) as alive
      from o left join suppliers p on p.supplier_id = o.id where o.id <> '' group by 1, 2),
r as (select po_row_id, strftime(created_at, '%Y-%m') as po_month, case when n = 0 then 'missing' when known = 0 then 'late' else 'deleted' end as reason from x where alive = 0)
"""
_MONTHLY = _ORPHANS + "select 'po_master' as table_name, po_month as period, reason, count(*) as orphans from r group by all"

_LINES = "select po_row_id, po_id, unnest(po_lines) as l, generate_subscripts(po_lines, 1) as line_pos from po_master"
_UNITS = "select book_row_id, company_code, unnest(business_units) as u, generate_subscripts(business_units, 1) as unit_pos from chart_of_books"
_LOCATIONS = f"select book_row_id, company_code, unit_pos, u, unnest(u.locations) as l, generate_subscripts(u.locations, 1) as location_pos from ({_UNITS})"


def _json_list(v: str) -> str:
    """SQL: the JSON value v as a list of JSON values."""
    one = "case json_type({0}) when 'ARRAY' then cast({0} as json[]) when 'OBJECT' then [{0}] end"
    text = f"json_extract_string({v}, '$')"
    return f"coalesce(case json_type({v}) when 'VARCHAR' then case when json_valid({text}) then {one.format(f'cast({text} as json)')} end else {one.format(v)} end, [])"


FEED_SQL = f"""
j as (select feed_id, master_name, cast(payload as json) as v from master_feed where json_valid(payload)),
r as (select feed_id, master_name, {_json_list("coalesce(case when json_type(v) = 'OBJECT' then coalesce(json_extract(v, '$.purchase_orders'), json_extract(v, '$.companies')) end, v)")} as recs from j),
e as (select feed_id, master_name, unnest(recs) as o, generate_subscripts(recs, 1) as p from r),
pl as (select feed_id, p, json_extract_string(o, '$.po_id') as parent, {_json_list("json_extract(o, '$.po_lines')")} as ls from e where master_name = 'po_master'),
fl as (select feed_id, p, parent, unnest(ls) as l, generate_subscripts(ls, 1) as i from pl),
bu as (select feed_id, p, {_json_list("json_extract(o, '$.business_units')")} as us from e where master_name = 'chart_of_books'),
bv as (select feed_id, p, unnest(us) as u, generate_subscripts(us, 1) as i from bu),
bw as (select feed_id, p, i, json_extract_string(u, '$.business_unit_code') as parent, {_json_list("json_extract(u, '$.locations')")} as ls from bv),
bl as (select feed_id, p, i, parent, unnest(ls) as l, generate_subscripts(ls, 1) as k from bw)
"""

SQL = {
    "p6_feed_orders": f"""with {FEED_SQL}, f as (select feed_id, p, o, {_json_list("json_extract(o, '$.po_lines')")} as ls from e where master_name = 'po_master' and json_type(o) = 'OBJECT')
        select feed_id as row_id, cast(p as int) as order_pos, json_extract_string(o, '$.po_id') as po_id, json_extract_string(o, '$.po_number') as po_number, json_extract_string(o, '$.supplier_id') as supplier_id, json_extract_string(o, '$.currency') as currency, cast(len(ls) as int) as n_lines from f""",
    "p3_found": _ORPHANS + "select * from r",
    "p3_monthly": _MONTHLY,
    "p3_replayed": _MONTHLY,
    "p6_found": f"""with {FEED_SQL}
        select 'chart_of_books' as src_table, book_row_id as row_id, unit_pos || '.' || location_pos as node_path, coalesce(u.business_unit_code, '') as parent_key, coalesce(l.location_code, '') as child_key from ({_LOCATIONS}) where l is not null
        union all select 'po_master', po_row_id, cast(line_pos as varchar), coalesce(po_id, ''), coalesce(l.line_id, '') from ({_LINES}) where l is not null
        union all select 'master_feed', feed_id, p || '.' || i, coalesce(parent, ''), coalesce(json_extract_string(l, '$.line_id'), '') from fl where json_type(l) = 'OBJECT'
        union all select 'master_feed', feed_id, p || '.' || i || '.' || k, coalesce(parent, ''), coalesce(json_extract_string(l, '$.location_code'), '') from bl where json_type(l) = 'OBJECT'""",
    "p6_order_lines": f"select po_row_id as row_id, po_id, cast(line_pos as int) as line_pos, l.line_id as line_id, l.description as description, l.quantity as quantity, l.uom as uom, l.unit_price as unit_price from ({_LINES}) where l is not null",
    "p6_orders": "select po_row_id as row_id, po_id, po_number, supplier_id, currency, cast(coalesce(len(po_lines), 0) as int) as n_lines from po_master",
    "p6_companies": "select book_row_id as row_id, company_code, company_name, cast(coalesce(len(business_units), 0) as int) as n_units from chart_of_books",
    "p6_units": f"select book_row_id as row_id, company_code, cast(unit_pos as int) as unit_pos, u.business_unit_code as business_unit_code, u.business_unit_name as business_unit_name, cast(coalesce(len(u.locations), 0) as int) as n_locations from ({_UNITS}) where u is not null",
    "p6_locations": f"select book_row_id as row_id, company_code, cast(unit_pos as int) as unit_pos, u.business_unit_code as business_unit_code, cast(location_pos as int) as location_pos, l.location_code as location_code, l.location_name as location_name, l.invoice_to_address as invoice_to_address from ({_LOCATIONS}) where l is not null",
}
