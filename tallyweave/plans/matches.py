"""Queries on exact matching, consensus and sets, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import text as X
from tallyweave.operators import consensus as C
from tallyweave.operators import matching as M
from tallyweave.operators import nested
from tallyweave.sources.tables import table

def q_location_match(spark: SparkSession, d: str) -> DataFrame:
    """Location records against the chart of books: by location code, held against unit and company."""
    obs = table(spark, d, "location_records").select(F.col("location_row_id").alias("obs_id"), "location_code", "business_unit_code", "company_code")
    leaves = nested.locations(table(spark, d, "chart_of_books")).select("location_code", "business_unit_code", "company_code")
    return M.hierarchical(obs, leaves, "location_code", ["business_unit_code", "company_code"])


def q_master_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return M.duplicates(table(spark, d, "suppliers").select("supplier_id"), ["supplier_id"])


def q_master_violations(spark: SparkSession, d: str) -> DataFrame:
    return M.violations(table(spark, d, "suppliers"), "supplier_row_id", {"name_required": "trim(name) <> ''", "vat_required": "trim(vat_id) <> ''", "country_two_letters": "length(country) = 2", "email_has_at": "email like '%@%'"})


def q_orphan_po(spark: SparkSession, d: str) -> DataFrame:
    """Orders of each supplier that has any, with suppliers that have none kept: a full picture of both sides."""
    o = table(spark, d, "po_master").groupBy(X.code_key(F.col("supplier_id")).alias("supplier_id")).agg(F.count(F.lit(1)).alias("n_orders"))
    s = table(spark, d, "suppliers").groupBy("supplier_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return o.join(s, "supplier_id", "full").select("supplier_id", "n_orders", "n_rows")


def _observed(spark: SparkSession, d: str) -> DataFrame:
    return C.observations(table(spark, d, "suppliers"), "supplier_id", ["name", "vat_id", "country", "email", "bank_iban", "address"], "supplier_row_id")


def q_consensus(spark: SparkSession, d: str) -> DataFrame:
    return C.consensus(_observed(spark, d))


def q_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return C.conflicts(_observed(spark, d))


def q_first_known(spark: SparkSession, d: str) -> DataFrame:
    return C.first_known(table(spark, d, "suppliers"), "supplier_id", ["name", "vat_id", "email", "bank_iban", "deleted_at"], ["loaded_at", "supplier_row_id"])


def q_complementary(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order clustered by what they do not contradict: unit, description and price, some unknown."""
    lines = nested.order_lines(table(spark, d, "po_master"))
    return C.complementary(lines.where("po_id is not null"), ["row_id"], ["line_pos"], ["line_id", "uom", "description"])


def q_paired_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the first and the last delivery of an order paired one to one by id and price."""
    lines = nested.order_lines(table(spark, d, "po_master")).withColumn("line_no", F.col("line_pos").cast("long"))
    deliveries = table(spark, d, "po_master").groupBy("po_id").agg(F.min("po_row_id").alias("first"), F.max("po_row_id").alias("last")).where("first < last")
    lines = lines.join(deliveries, "po_id")
    side = lambda which: lines.where(F.col("row_id") == F.col(which)).select("po_id", "line_no", F.trim("line_id").alias("line_id"), F.trim("unit_price").alias("unit_price"))
    return C.paired(side("first"), side("last"), ["po_id"], ["line_id", "unit_price"], "line_no")


def q_set_operations(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of union, intersection and difference of the parties of both sides, as sets and as bags."""
    a, b = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), table(spark, d, "customer").select(F.col("c_nationkey").alias("k"))
    size = lambda name, df: df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("k").cast("long").alias("sum_k")).select(F.lit(name).alias("operation"), "n_rows", "sum_k")
    out = size("union_all", a.unionByName(b))
    for name, df in (("union", a.unionByName(b).distinct()), ("intersect", a.intersect(b)), ("intersect_all", a.intersectAll(b)), ("except", a.subtract(b)), ("except_all", b.exceptAll(a))):
        out = out.unionByName(size(name, df))
    return out


QUERIES = {f.__name__: f for f in (q_location_match, q_master_duplicates, q_master_violations, q_orphan_po, q_consensus, q_conflicts, q_first_known, q_complementary, q_paired_lines, q_set_operations)}

_TRIM = r"regexp_replace({0}, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')"
_FIELDS = ["name", "vat_id", "country", "email", "bank_iban", "address"]
_OBS = "ob as (" + " union all ".join(f"select supplier_id as key, '{f}' as field, trim({f}) as value, supplier_row_id as evidence from suppliers where trim({f}) <> '' and supplier_id is not null" for f in _FIELDS) + "), sv as (select key, field, value, count(*) as n_seen, min(evidence) as first_evidence from ob group by 1, 2, 3)"

SQL = {
    "q_location_match": """with lv as (select distinct l.location_code as location_code, u.business_unit_code as bu, company_code as co from (select company_code, u, unnest(u.locations) as l from (select company_code, unnest(business_units) as u from chart_of_books)) where l.location_code <> ''),
        c as (select location_row_id as obs_id, count(lv.location_code) as n0, count(*) filter (lv.location_code is not null and (coalesce(business_unit_code, '') = '' or business_unit_code = bu)) as n1,
        count(*) filter (lv.location_code is not null and (coalesce(business_unit_code, '') = '' or business_unit_code = bu) and (coalesce(company_code, '') = '' or company_code = co)) as n2 from location_records r left join lv on lv.location_code = r.location_code group by 1)
        select obs_id, case when n0 = 0 then 'no_match' when n2 = 1 then 'matched' else 'ambiguous' end as status, n2 as n_leaves, case when n0 = 0 then 'none' when n1 = 0 then 'conflicting_business_unit_code' when n2 = 0 then 'conflicting_company_code' when n2 = 1 then 'exact_leaf' else 'ambiguous_leaf' end as method from c""",
    "q_master_duplicates": "select supplier_id, count(*) as n_rows from suppliers group by 1 having count(*) > 1",
    "q_master_violations": " union all ".join(f"select supplier_row_id, '{n}' as rule from suppliers where not coalesce({c}, false)" for n, c in {"name_required": "trim(name) <> ''", "vat_required": "trim(vat_id) <> ''", "country_two_letters": "length(country) = 2", "email_has_at": "email like '%@%'"}.items()),
    "q_orphan_po": f"with o as (select {_TRIM.format('supplier_id')} as supplier_id, count(*) as n_orders from po_master group by 1), s as (select supplier_id, count(*) as n_rows from suppliers group by 1) select coalesce(o.supplier_id, s.supplier_id) as supplier_id, n_orders, n_rows from o full join s on o.supplier_id = s.supplier_id",
    "q_consensus": f"with {_OBS} select key, field, case when count(*) = 1 then max(value) end as value, count(*) as n_values, cast(sum(n_seen) as bigint) as n_seen from sv group by 1, 2",
    "q_conflicts": f"with {_OBS} select * from (select *, count(*) over (partition by key, field) as n_values from sv) where n_values > 1",
    "q_first_known": "select supplier_id, " + ", ".join(f"arg_min({f}, (loaded_at, supplier_row_id)) filter ({f} is not null) as {f}" for f in ["name", "vat_id", "email", "bank_iban", "deleted_at"]) + " from suppliers where supplier_id is not null group by 1",
    "q_set_operations": "with a as (select s_nationkey as k from supplier), b as (select c_nationkey as k from customer) "
    + " union all ".join(f"select '{n}' as operation, count(*) as n_rows, cast(sum(k) as bigint) as sum_k from ({q})" for n, q in {"union_all": "select k from a union all select k from b", "union": "select k from a union select k from b", "intersect": "select k from a intersect select k from b", "intersect_all": "select k from a intersect all select k from b", "except": "select k from a except select k from b", "except_all": "select k from b except all select k from a"}.items()),
}
