"""Queries on matching against master data by ordered rules, with their SQL."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import text as X
from tallyweave.operators import masters as R
from tallyweave.operators import nested
from tallyweave.plans.general import FEED_SQL
from tallyweave.sources.tables import table


def _upper(c: str):  # noqa: ANN202
    return F.upper(X.code_key(F.col(c)))


def supplier_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col(key).alias(name), X.identifier_key(F.col("vat_id")).alias("vat"), X.name_key(F.col("name")).alias("name"), F.lower(X.code_key(F.col("email"))).alias("email"), X.account_key(F.col("bank_iban")).alias("iban"), _upper("country").alias("country"))


def q_supplier_match(spark: SparkSession, d: str) -> DataFrame:
    """Observed suppliers against the master."""
    return R.match_suppliers(supplier_keys(table(spark, d, "observed_supplier_identity"), "obs_id", "obs_id"), supplier_keys(table(spark, d, "suppliers"), "supplier_id", "cand_id"))


def q_supplier_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return q_supplier_match(spark, d).groupBy("status", "method").agg(F.count(F.lit(1)).alias("n_obs"))


def q_buyer_match(spark: SparkSession, d: str) -> DataFrame:
    """Location records, and units and companies by their names, against the chart of books."""
    books = table(spark, d, "chart_of_books")
    code, name = (lambda c: X.code_key(F.col(c))), (lambda c: X.name_key(F.col(c)))
    places = nested.locations(books).select(code("location_code").alias("location_code"), name("location_name").alias("location_name"), code("business_unit_code").alias("bu_code"), code("company_code").alias("company_code"))
    rows = books.selectExpr(
        "book_row_id", "company_code",
        "inline(filter(transform(business_units, (u, i) -> struct(i + 1 as pos, u.business_unit_code as bu, u.business_unit_name as bu_name, filter(u.locations, l -> l is not null) as ls, u is not null as ok)), s -> s.ok))",
    )
    ordinal = F.format_string("%012d.%06d", F.col("book_row_id"), F.col("pos"))
    units = rows.select(ordinal.alias("ordinal"), code("bu").alias("bu_code"), name("bu_name").alias("bu_name"), code("company_code").alias("company_code"), F.expr("if(size(ls) = 1, trim(ls[0].location_code), null)").alias("only_location"))
    companies = books.select(F.format_string("%012d", F.col("book_row_id")).alias("ordinal"), code("company_code").alias("company_code"), name("company_name").alias("company_name"))
    none = F.lit(None).cast("string")
    seen = table(spark, d, "location_records").select(F.concat(F.lit("loc:"), F.col("location_row_id").cast("string")).alias("obs_id"), code("location_code").alias("location_code"), name("location_name").alias("location_name"), code("invoice_to_address").alias("address"), code("business_unit_code").alias("bu_code"), none.alias("bu_name"), code("company_code").alias("company_code"), none.alias("company_name"))
    by_unit = units.select(F.concat(F.lit("unit:"), "ordinal").alias("obs_id"), none.alias("location_code"), none.alias("location_name"), none.alias("address"), none.alias("bu_code"), "bu_name", "company_code", none.alias("company_name"))
    by_company = companies.select(F.concat(F.lit("company:"), "ordinal").alias("obs_id"), none.alias("location_code"), none.alias("location_name"), none.alias("address"), none.alias("bu_code"), none.alias("bu_name"), none.alias("company_code"), "company_name")
    return R.match_buyers(seen.unionByName(by_unit).unionByName(by_company), places, units, companies)


#: Taxes of every nation, as the tables have no tax master: (suffix of the code, kind, name, rate in percent).
TAXES = (("STD", "VAT", "value added tax", 8), ("RED", "VAT", "reduced tax", 4), ("ZER", "VAT", "value added tax", 0), ("HEA", "LEVY", "health levy", 2), ("EDU", "LEVY", "education levy", 2), ("ROA", "LEVY", "road levy", 6))


def q_tax_match(spark: SparkSession, d: str) -> DataFrame:
    """Taxes of suppliers' order lines against the taxes of their nations: explicit codes at 5 and 6 percent, kinds and names by the line's flags."""
    nations = table(spark, d, "nation")
    rows = F.inline(F.array(*(F.struct(F.lit(s).alias("suffix"), F.lit(k).alias("kind"), F.lit(n).alias("name"), F.lit(r).cast("decimal(18,6)").alias("rate")) for s, k, n, r in TAXES)))
    master = nations.select("n_name", rows).select(F.concat_ws("-", "n_name", "suffix").alias("code"), F.upper("n_name").alias("country"), "kind", "name", "rate")
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_tax", "l_returnflag", "l_linestatus").distinct()
    suppliers = table(spark, d, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
    pct = F.bround(F.col("l_tax") * 100).cast("int")
    obs = lines.join(suppliers, "l_suppkey").select(
        F.concat_ws(":", "l_suppkey", pct, "l_returnflag", "l_linestatus").alias("obs_id"),
        F.when(pct == 5, F.concat("n_name", F.lit("-STD"))).when((pct == 6) & (F.col("l_linestatus") == "F"), F.lit("NO-SUCH")).when(pct == 8, F.concat("n_name", F.lit("-STD"))).alias("code"),
        F.upper("n_name").alias("country"),
        F.when(F.col("l_returnflag") == "A", "VAT").when((F.col("l_returnflag") == "R") & (pct < 7), "LEVY").alias("kind"),
        F.when(F.col("l_linestatus") == "O", F.when(F.col("l_returnflag") == "R", "health levy").otherwise("value added tax")).when(F.col("l_returnflag") == "N", "reduced tax").alias("name"),
        X.rate(F.concat(pct.cast("string"), F.lit(" %"))).alias("rate"),
    )
    return R.match_taxes(obs, master)


def q_po_match(spark: SparkSession, d: str) -> DataFrame:
    """Order numbers of the inventory, whole orders of the feed and every delivery against the orders, one row per order id as first delivered."""
    trimmed = lambda c: F.btrim(X.code_key(F.col(c)), F.lit(" \"'.,;:()[]{}"))
    none = F.lit(None).cast("string")
    inv = table(spark, d, "document_inventory").select("inventory_id", F.explode(F.split("po_number_candidates", "[|,;]")).alias("n"))
    inv = inv.select(F.concat_ws(":", F.lit("inv"), "inventory_id", trimmed("n")).alias("obs_id"), trimmed("n").alias("number"), none.alias("supplier"), none.alias("currency"), F.array().cast("array<string>").alias("descriptions"))
    feed = table(spark, d, "master_feed")
    lines = nested.feed_order_lines(feed).where("description is not null").groupBy("row_id", "order_pos").agg(F.collect_set(F.lower(F.trim("description"))).alias("descriptions"))
    feed = nested.feed_orders(feed).join(lines, ["row_id", "order_pos"], "left").select(F.concat_ws(":", F.lit("feed"), "row_id", "order_pos").alias("obs_id"), trimmed("po_number").alias("number"), X.code_key(F.col("supplier_id")).alias("supplier"), _upper("currency").alias("currency"), F.coalesce("descriptions", F.array().cast("array<string>")).alias("descriptions"))
    first = F.struct("po_number", "supplier_id", "currency", F.expr("transform(filter(po_lines, l -> l is not null), l -> lower(trim(l.description)))").alias("descriptions"))
    orders = table(spark, d, "po_master").where("po_id is not null").groupBy("po_id").agg(F.min_by(first, "po_row_id").alias("x"))
    master = orders.select(F.col("po_id").alias("cand_id"), X.code_key(F.col("x.po_number")).alias("number"), X.code_key(F.col("x.supplier_id")).alias("supplier"), _upper("x.currency").alias("currency"), F.coalesce("x.descriptions", F.array().cast("array<string>")).alias("descriptions"))
    descriptions = F.expr("transform(filter(coalesce(po_lines, array()), l -> l is not null), l -> lower(trim(l.description)))")
    deliveries = table(spark, d, "po_master").select(F.concat_ws(":", F.lit("po"), "po_row_id").alias("obs_id"), trimmed("po_number").alias("number"), X.code_key(F.col("supplier_id")).alias("supplier"), _upper("currency").alias("currency"), descriptions.alias("descriptions"))
    return R.match_orders(inv.unionByName(feed).unionByName(deliveries), master)


#: Payment terms, as the tables have none: (id, days, aliases).
TERMS = (("T00", 0, ("1-urgent", "at once")), ("T0A", 0, ("in advance",)), ("T14", 14, ("2-high", "14 days")), ("T30", 30, ("3-medium", "30 days")), ("T30E", 30, ("3-medium", "end of month")), ("T45", 45, ("4-not specified",)), ("T60", 60, ("5-low", "60 days")))


def q_terms_match(spark: SparkSession, d: str) -> DataFrame:
    """Orders' priorities as texts, days by customer, ids where the order is pending, against the terms."""
    master = spark.createDataFrame([(i, n, list(a)) for i, n, a in TERMS], "term_id string, days int, aliases array<string>")
    days = F.expr("case when o_orderstatus = 'O' then null when o_custkey % 5 = 0 then 30 when o_custkey % 5 = 1 then 14 when o_custkey % 5 = 2 then 0 when o_custkey % 5 = 3 then 45 else 90 end")
    term = F.expr("case when o_orderstatus = 'P' and o_custkey % 7 < 3 then 'T30' when o_orderstatus = 'P' and o_custkey % 7 = 3 then 'T99' end")
    text = F.expr("case when o_custkey % 3 = 0 and o_orderstatus <> 'O' then null else lower(trim(o_orderpriority)) end")
    return R.match_terms(table(spark, d, "orders").select(F.col("o_orderkey").alias("obs_id"), term.alias("term_id"), text.alias("text"), days.alias("days")), master)


QUERIES = {f.__name__: f for f in (q_supplier_match, q_supplier_outcomes, q_buyer_match, q_tax_match, q_po_match, q_terms_match)}

TRIM = r"regexp_replace({0}, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')"
NAME = r"trim(trim(regexp_replace(replace(lower(nfc_normalize({0})), 'ß', 'ss'), '[\s\pZ]+', ' ', 'g')), ' ''.,;:()[]{{}}""')"


def decided(rules: list[tuple[str, str, str, str]], source: str, extra: str = "") -> str:
    """SQL: the first of (condition, status, master id, method) that holds."""
    pick = lambda k, last: "case " + " ".join(f"when {r[0]} then {r[k] if k == 2 else repr(r[k])}" for r in rules) + f" else {last} end"
    return f"select obs_id, {pick(1, "'no_match'")} as status, cast({pick(2, 'null')} as varchar) as master_id, {pick(3, "'none'")} as method {extra} from {source}"


_S = ("vat", "name", "email", "iban")
_KEYS = lambda key, t: rf"select {key}, regexp_replace(upper(vat_id), '[\s\-.]+', '', 'g') as vat, {NAME.format('name')} as name, lower({TRIM.format('email')}) as email, regexp_replace(upper(bank_iban), '[\s\-]+', '', 'g') as iban, coalesce(upper({TRIM.format('country')}), '') as country from {t}"
_LONG = lambda key, t: " union all ".join(f"select {key}, country, '{s}' as s, {s} as v from {t} where {s} <> ''" for s in _S)
_N = [x for s in _S for x in (s, f"{s}_c")]
_APART = " or ".join(f"(n_{a} > 0 and n_{b} > 0 and n_{a}_{b} = 0)" for a, b in combinations(_S, 2))
_SUPPLIER_RULES = [
    (f"({_APART})", "ambiguous", "null", "conflicting_identity_evidence"),
    ("country <> '' and n_vat > 0 and n_vat_c = 0", "ambiguous", "null", "conflicting_vat_and_country"),
    ("country <> '' and n_vat_c = 1", "matched", "m_vat_c", "exact_vat_id"),
    ("country = '' and n_vat = 1", "matched", "m_vat", "exact_vat_id"),
    ("n_vat > 0", "ambiguous", "null", "ambiguous_vat_id"),
    ("country <> '' and n_name_c = 1", "matched", "m_name_c", "exact_normalized_name_country"),
    ("country <> '' and n_name_c > 1", "ambiguous", "null", "ambiguous_name_country"),
    ("country <> '' and n_name > 0", "ambiguous", "null", "conflicting_name_and_country"),
    ("n_name = 1", "matched", "m_name", "exact_normalized_name"),
    ("n_name > 1", "ambiguous", "null", "ambiguous_normalized_name"),
    *(r for s in ("email", "iban") for r in ((f"country <> '' and n_{s} = 1 and n_{s}_c = 0", "ambiguous", "null", f"conflicting_{s}_and_country"), (f"n_{s} = 1", "matched", f"m_{s}", f"exact_{s}"), (f"n_{s} > 1", "ambiguous", "null", f"ambiguous_{s}"))),
]
_SUPPLIER = f"""with o as ({_KEYS('obs_id', 'observed_supplier_identity')}), m as ({_KEYS('supplier_id as cand_id', 'suppliers')}), ol as ({_LONG('obs_id', 'o')}), ml as ({_LONG('cand_id', 'm')}),
f as (select ol.obs_id, ml.cand_id, {', '.join(f"bool_or(ol.s = '{s}') as {s}, bool_or(ol.s = '{s}' and ol.country = ml.country) as {s}_c" for s in _S)} from ol join ml on ol.s = ml.s and ol.v = ml.v group by 1, 2),
g as (select obs_id, {', '.join(f'count(*) filter ({x}) as n_{x}, min(cand_id) filter ({x}) as m_{x}' for x in _N)}, {', '.join(f'count(*) filter ({a} and {b}) as n_{a}_{b}' for a, b in combinations(_S, 2))} from f group by 1),
z as (select o.obs_id, o.country, g.* exclude (obs_id) from o left join g using (obs_id)), r as ({decided(_SUPPLIER_RULES, 'z')}) """

_BUYER_KEY = lambda code, name: f"case when coalesce({code}, '') <> '' then 'c|' || {code} when coalesce({name}, '') <> '' then 'n|' || {name} end"
_PLACE = "(coalesce(location_code, '') <> '' or coalesce(location_name, '') <> '' or coalesce(address, '') <> '')"
_BY_UNIT = "(coalesce(bu_code, '') <> '' or coalesce(bu_name, '') <> '')"
_BUYER_RULES = [
    (f"{_PLACE} and coalesce(l0, 0) = 0", "no_match", "null", "none"),
    (f"{_PLACE} and coalesce(bu_code, '') <> '' and l1 = 0", "ambiguous", "null", "conflicting_bu_and_location"),
    (f"{_PLACE} and coalesce(company_code, '') <> '' and lx = 0", "ambiguous", "null", "conflicting_company_and_location"),
    (f"{_PLACE} and lx = 1 and (coalesce(bu_code, '') <> '' or coalesce(company_code, '') <> '' or (coalesce(bu_name, '') <> '' and l2 > 0))", "matched", "mx", "hierarchical_location"),
    (f"{_PLACE} and lx = 1", "matched", "mx", "exact_location_code"),
    (_PLACE, "ambiguous", "null", "ambiguous_location_code"),
    (f"{_BY_UNIT} and coalesce(u0, 0) = 0", "no_match", "null", "none"),
    (f"{_BY_UNIT} and u1 = 0", "ambiguous", "null", "conflicting_company_and_bu"),
    (f"{_BY_UNIT} and u1 = 1 and coalesce(bu_code, '') <> ''", "matched", "mu", "exact_business_unit_code"),
    (f"{_BY_UNIT} and u1 = 1", "matched", "mu", "exact_normalized_bu_name"),
    (_BY_UNIT, "ambiguous", "null", "ambiguous_business_unit"),
    ("co is not null and coalesce(company_code, '') <> ''", "matched", "co", "exact_company_code"),
    ("co is not null", "matched", "co", "exact_company_name"),
]
_BUYER = f"""with uu as (select book_row_id, company_code, unnest(business_units) as u, generate_subscripts(business_units, 1) as pos from chart_of_books),
un as (select printf('%012d.%06d', book_row_id, pos) as ordinal, {TRIM.format('u.business_unit_code')} as bu_code, {NAME.format('u.business_unit_name')} as bu_name, {TRIM.format('company_code')} as company_code, list_filter(u.locations, lambda l: l is not null) as ls from uu where u is not null),
units as (select *, case when len(ls) = 1 then trim(ls[1].location_code) end as only_location from un),
pl as (select company_code, bu_code, unnest(ls) as l from units), fn as (select bu_code, arg_min(bu_name, ordinal) as fname from units where bu_code <> '' and bu_name is not null group by 1),
places as (select distinct {TRIM.format('l.location_code')} as location_code, {NAME.format('l.location_name')} as location_name, pl.bu_code, company_code, fname from pl left join fn on fn.bu_code = pl.bu_code),
co as (select printf('%012d', book_row_id) as ordinal, {TRIM.format('company_code')} as company_code, {NAME.format('company_name')} as company_name from chart_of_books),
o as (select 'loc:' || location_row_id as obs_id, {TRIM.format('location_code')} as location_code, {NAME.format('location_name')} as location_name, {TRIM.format('invoice_to_address')} as address, {TRIM.format('business_unit_code')} as bu_code, null as bu_name, {TRIM.format('company_code')} as company_code, null as company_name from location_records
  union all select 'unit:' || ordinal, null, null, null, null, bu_name, company_code, null from units union all select 'company:' || ordinal, null, null, null, null, null, null, company_name from co),
k as (select *, {_BUYER_KEY('location_code', 'location_name')} as lk, {_BUYER_KEY('bu_code', 'bu_name')} as uk, {_BUYER_KEY('company_code', 'company_name')} as ck from o),
pi as (select distinct 'c|' || location_code as key, location_code, bu_code, company_code, fname from places where location_code <> '' union select distinct 'n|' || location_name, location_code, bu_code, company_code, fname from places where location_name <> ''),
pa as (select k.obs_id, k.bu_name, coalesce(pi.location_code, '') as loc, coalesce(pi.location_code, '') || '|' || coalesce(pi.bu_code, '') || '|' || coalesce(pi.company_code, '') as cand, coalesce(k.bu_code, '') = '' or k.bu_code = pi.bu_code as uok, coalesce(k.company_code, '') = '' or k.company_code = pi.company_code as cok, coalesce(k.bu_name = fname, false) as nok from k join pi on k.lk = pi.key),
la as (select obs_id, count(distinct cand) as l0, count(distinct cand) filter (uok) as l1, count(distinct cand) filter (uok and nok) as l2, count(distinct cand) filter (uok and cok) as l3, count(distinct cand) filter (uok and nok and cok) as l4, min(cand) filter (uok and cok) as m3, min(cand) filter (uok and nok and cok) as m4 from pa group by 1),
ur as (select company_code, bu_code, arg_min(bu_name, ordinal) filter (bu_name is not null) as bu_name, arg_min(only_location, ordinal) filter (only_location is not null) as only_location from units group by all),
ui as (select 'c|' || bu_code as key, * from ur where bu_code <> '' union all select 'n|' || bu_name, * from ur where bu_name <> ''),
ua as (select k.obs_id, count(distinct ui.bu_code || '|' || coalesce(ui.company_code, '')) as u0, count(distinct ui.bu_code || '|' || coalesce(ui.company_code, '')) filter (coalesce(k.company_code, '') = '' or k.company_code = ui.company_code) as u1,
  min(coalesce(nullif(ui.only_location, ''), ui.bu_code)) filter (coalesce(k.company_code, '') = '' or k.company_code = ui.company_code) as mu from k join ui on k.uk = ui.key group by 1),
ci as (select key, arg_min(company_code, ordinal) as co from (select 'c|' || company_code as key, ordinal, company_code from co where company_code <> '' union all select 'n|' || company_name, ordinal, company_code from co where company_name <> '' and company_code <> '') group by 1),
z as (select k.*, l0, l1, l2, case when coalesce(k.bu_name, '') <> '' and l2 > 0 then l4 else l3 end as lx, string_split(case when coalesce(k.bu_name, '') <> '' and l2 > 0 then m4 else m3 end, '|')[1] as mx, u0, u1, mu, ci.co from k left join la using (obs_id) left join ua using (obs_id) left join ci on ci.key = k.ck)
{decided(_BUYER_RULES, 'z')}"""

_TAX_MASTER = " union all ".join(f"select n_name || '-{s}' as code, upper(n_name) as country, '{k}' as kind, '{n}' as name, {r} as rate from nation" for s, k, n, r in TAXES)
_T = "country <> '' and rate is not null"
_TAX_RULES = [
    ("code <> '' and mc is null", "no_match", "null", "none"),
    ("code <> '' and (country <> mc or rate <> mr or (kind <> '' and kind <> mk) or (name <> '' and name <> mn and alt <> code))", "ambiguous", "null", "conflicting_tax_code_and_properties"),
    ("code <> ''", "matched", "code", "exact_tax_code"),
    (f"{_T} and kind <> '' and name <> '' and nn > 0 and nboth = 0", "ambiguous", "null", "conflicting_tax_name_and_rate"),
    (f"{_T} and kind <> '' and nt = 1", "matched", "t1", "exact_country_tax_type_rate"),
    (f"{_T} and kind <> '' and nt > 1", "ambiguous", "null", "ambiguous_country_tax_type_rate"),
    (f"{_T} and name <> '' and nr = 1", "matched", "r1", "exact_country_name_rate"),
    (f"{_T} and name <> '' and nr > 1", "ambiguous", "null", "ambiguous_country_name_rate"),
    (f"{_T} and name <> '' and nn > 0", "ambiguous", "null", "conflicting_name_and_rate"),
    ("country <> '' and name <> '' and nn = 1", "matched", "n1", "exact_country_name"),
    ("country <> '' and name <> '' and nn > 1", "ambiguous", "null", "ambiguous_country_name"),
]
_TAX = f"""with m as ({_TAX_MASTER}), li as (select distinct l_suppkey, l_tax, l_returnflag as f, l_linestatus as s, cast(round_even(l_tax * 100, 0) as int) as p from lineitem),
o as (select l_suppkey || ':' || p || ':' || f || ':' || s as obs_id, case when p = 5 or p = 8 then n_name || '-STD' when p = 6 and s = 'F' then 'NO-SUCH' else '' end as code, upper(n_name) as country, case when f = 'A' then 'VAT' when f = 'R' and p < 7 then 'LEVY' else '' end as kind,
  case when s = 'O' and f = 'R' then 'health levy' when s = 'O' then 'value added tax' when f = 'N' then 'reduced tax' else '' end as name, p as rate from li join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey),
c as (select obs_id, count(*) filter (m.kind = o.kind and m.rate = o.rate) as nt, min(m.code) filter (m.kind = o.kind and m.rate = o.rate) as t1, count(*) filter (m.name = o.name) as nn, min(m.code) filter (m.name = o.name) as n1,
  count(*) filter (m.name = o.name and m.rate = o.rate) as nr, min(m.code) filter (m.name = o.name and m.rate = o.rate) as r1, count(*) filter (m.name = o.name and m.kind = o.kind and m.rate = o.rate) as nboth from o join m on m.country = o.country group by 1),
z as (select distinct o.*, c.* exclude (obs_id), mm.country as mc, mm.rate as mr, mm.kind as mk, mm.name as mn, (select min(a.code) from m a where a.country = mm.country and a.name = o.name) as alt from o left join c using (obs_id) left join m mm on mm.code = o.code)
{decided(_TAX_RULES, 'z')}"""

_STRIP = lambda c: f"trim({TRIM.format(c)}, ' \"''.,;:()[]{{}}')"
_SUP, _CUR = "coalesce(supplier, '') <> ''", "coalesce(currency, '') <> ''"
_ONE = "n = 1"
_PO_RULES = [
    (f"{_ONE} and (({_SUP} and ns = 0) or ({_CUR} and nc = 0)) and {_SUP} and owns", "ambiguous", "null", "conflicting_po_and_supplier"),
    (f"{_ONE} and (({_SUP} and ns = 0) or ({_CUR} and nc = 0))", "no_match", "null", "conflicting_po_constraints"),
    (f"{_ONE} and {_SUP} and {_CUR}", "matched", "m", "exact_po_number_supplier_currency"),
    (f"{_ONE} and {_SUP}", "matched", "m", "exact_po_number_supplier"),
    (f"{_ONE} and {_CUR}", "matched", "m", "exact_po_number_currency"),
    (f"{_ONE} and nl > 0", "matched", "m", "exact_po_number_line_evidence"),
    (_ONE, "matched", "m", "exact_po_number"),
    ("n > 1 and left_n = 1 and by_s and by_c", "matched", "left_m", "exact_po_number_supplier_currency"),
    ("n > 1 and left_n = 1 and by_s", "matched", "left_m", "exact_po_number_supplier"),
    ("n > 1 and left_n = 1 and by_c", "matched", "left_m", "exact_po_number_currency"),
    ("n > 1 and left_n = 1", "matched", "left_m", "exact_po_number"),
    ("n > 1", "ambiguous", "null", "ambiguous_po_number"),
]


def _po_sql(feed: str) -> str:
    """feed: the CTEs j, r, e, pl and fl of the feed's orders and lines."""
    return f"""with {feed},
fo as (select feed_id, p, json_extract_string(o, '$.po_number') as n, json_extract_string(o, '$.supplier_id') as s, json_extract_string(o, '$.currency') as c from e where master_name = 'po_master' and json_type(o) = 'OBJECT'),
fd as (select feed_id, p, list(distinct lower(trim(json_extract_string(l, '$.description')))) as ds from fl where json_type(l) = 'OBJECT' and json_extract_string(l, '$.description') is not null group by 1, 2),
ic as (select inventory_id, unnest(string_split_regex(po_number_candidates, '[|,;]')) as n from document_inventory),
o as (select distinct 'inv:' || inventory_id || ':' || {_STRIP('n')} as obs_id, {_STRIP('n')} as number, null as supplier, null as currency, [] as ds from ic
  union all select 'feed:' || fo.feed_id || ':' || fo.p, {_STRIP('fo.n')}, {TRIM.format('fo.s')}, upper({TRIM.format('fo.c')}), coalesce(fd.ds, []) from fo left join fd on fd.feed_id = fo.feed_id and fd.p = fo.p
  union all select 'po:' || po_row_id, {_STRIP('po_number')}, {TRIM.format('supplier_id')}, upper({TRIM.format('currency')}), list_transform(list_filter(coalesce(po_lines, []), lambda l: l is not null), lambda l: lower(trim(l.description))) from po_master),
m as (select po_id as cand, {TRIM.format('po_number')} as number, {TRIM.format('supplier_id')} as supplier, upper({TRIM.format('currency')}) as currency, coalesce(list_transform(list_filter(po_lines, lambda l: l is not null), lambda l: lower(trim(l.description))), []) as ds from (select * from po_master where po_id is not null qualify row_number() over (partition by po_id order by po_row_id) = 1)),
st as (select obs_id, 0 as stage, 'n|' || number as k from o where number <> '' union all select obs_id, 1, 'n|' || upper(number) from o where number <> '' union all select obs_id, 2, 'i|' || number from o where number <> '' union all select obs_id, 3, 'i|' || upper(number) from o where number <> ''),
ix as (select 'n|' || number as k, * from m where number is not null union all select 'i|' || cand, * from m),
pr as (select distinct st.obs_id, st.stage, ix.cand, ix.supplier, ix.currency, ix.ds from st join ix using (k) qualify st.stage = min(st.stage) over (partition by st.obs_id)),
ct as (select o.obs_id, count(*) as n, count(*) filter (pr.supplier = o.supplier) as ns, count(*) filter (pr.currency = o.currency) as nc, count(*) filter (pr.supplier = o.supplier and pr.currency = o.currency) as nsc, count(*) filter (list_has_any(pr.ds, o.ds)) as nl,
  min(cand) as m, min(cand) filter (pr.supplier = o.supplier) as ms, min(cand) filter (pr.currency = o.currency) as mc, min(cand) filter (pr.supplier = o.supplier and pr.currency = o.currency) as msc from o join pr using (obs_id) group by 1),
y as (select o.obs_id, o.supplier, o.currency, ct.* exclude (obs_id), coalesce(o.supplier in (select supplier from m where supplier <> ''), false) as owns, {_SUP} and ns > 0 as by_s from o left join ct using (obs_id)),
x as (select *, {_CUR} and (case when by_s then nsc else nc end) > 0 as by_c from y),
z as (select *, case when by_s and by_c then nsc when by_s then ns when by_c then nc else n end as left_n, case when by_s and by_c then msc when by_s then ms when by_c then mc else m end as left_m from x)
{decided(_PO_RULES, 'z')}"""


_TERM_MASTER = " union all ".join(f"select '{i}' as term_id, {n} as days, {list(a)!r} as aliases" for i, n, a in TERMS)
_TERM_RULES = [
    ("term is not null and dd is null", "no_match", "null", "none"),
    ("term is not null and ((days is not null and days <> dd) or (text <> '' and na > 0 and not list_contains(ids, term)))", "ambiguous", "null", "conflicting_term_id_and_signals"),
    ("term is not null", "matched", "term", "exact_payment_term_id"),
    ("text <> '' and na > 0 and days is not null and nad = 0", "ambiguous", "null", "conflicting_text_and_days"),
    ("text <> '' and na > 0 and days is not null and nad = 1", "matched", "mad", "composite_alias_and_days"),
    ("text <> '' and na = 1 and days is null", "matched", "ma", "exact_normalized_alias"),
    ("text <> '' and na > 0", "ambiguous", "null", "ambiguous_alias"),
    ("nd = 1", "matched", "md", "exact_numeric_days"),
    ("nd > 1", "ambiguous", "null", "ambiguous_days"),
]
_TERMS_SQL = f"""with m as ({_TERM_MASTER}), a as (select term_id, days, unnest(aliases) as alias from m),
o as (select o_orderkey as obs_id, case when o_orderstatus = 'P' and o_custkey % 7 < 3 then 'T30' when o_orderstatus = 'P' and o_custkey % 7 = 3 then 'T99' end as term, case when o_custkey % 3 = 0 and o_orderstatus <> 'O' then null else lower(trim(o_orderpriority)) end as text,
  case when o_orderstatus = 'O' then null when o_custkey % 5 = 0 then 30 when o_custkey % 5 = 1 then 14 when o_custkey % 5 = 2 then 0 when o_custkey % 5 = 3 then 45 else 90 end as days from orders),
ac as (select o.obs_id, count(*) as na, min(a.term_id) as ma, list(a.term_id) as ids, count(*) filter (a.days = o.days) as nad, min(a.term_id) filter (a.days = o.days) as mad from o join a on a.alias = o.text group by 1),
dc as (select days, count(*) as nd, min(term_id) as md from m group by 1),
z as (select o.*, m.days as dd, na, ma, ids, nad, mad, nd, md from o left join m on m.term_id = o.term left join ac using (obs_id) left join dc on dc.days = o.days)
{decided(_TERM_RULES, 'z')}"""

SQL = {
    "q_supplier_match": _SUPPLIER + "select * from r",
    "q_supplier_outcomes": _SUPPLIER + "select status, method, count(*) as n_obs from r group by 1, 2",
    "q_buyer_match": _BUYER,
    "q_tax_match": _TAX,
    "q_po_match": _po_sql(FEED_SQL),
    "q_terms_match": _TERMS_SQL,
}
