"""Queries on documents as blocks of text, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import text as X
from tallyweave.operators import blocks as B
from tallyweave.operators import consensus as C
from tallyweave.operators import extract as R
from tallyweave.sources.tables import table

# Words that mark kinds of documents and rows, as patterns that Spark and DuckDB read alike.
LEXICONS = {
    "invoice": "(?i)(invoice|rechnung|facture|fatura|factura|arve)",
    "credit": "(?i)(credit note|gutschrift|avoir|nota de credito|creditnota)",
    "reminder": "(?i)(reminder|mahnung|erinnerung|relance|herinnering)",
    "delivery": "(?i)(delivery note|lieferschein|bon de livraison|guia de remessa|pakbon)",
    "total": "(?i)(total|gesamtbetrag|totaal)",
}
SCRIPTS = {"latin": "[A-Za-z]", "thai": "[\\x{0E00}-\\x{0E7F}]", "cyrillic": "[\\x{0400}-\\x{04FF}]", "cjk": "[\\x{4E00}-\\x{9FFF}]"}
NUMBER = "[A-Z]{1,3}[-/][0-9]{4,6}"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def q_blocks(spark: SparkSession, d: str) -> DataFrame:
    return B.blocks(_docs(spark, d))


def q_lexicon_blocks(spark: SparkSession, d: str) -> DataFrame:
    return B.lexicon_counts(B.blocks(_docs(spark, d)), LEXICONS)


def q_document_class(spark: SparkSession, d: str) -> DataFrame:
    return B.best_class(B.text_counts(_docs(spark, d), LEXICONS), {"credit": 2.0, "reminder": 1.75, "invoice": 1.5, "delivery": 1.0}, 0.5)


def q_doc_scripts(spark: SparkSession, d: str) -> DataFrame:
    return B.text_counts(_docs(spark, d), SCRIPTS)


def q_amounts(spark: SparkSession, d: str) -> DataFrame:
    """First and last amount of every block that has one."""
    a = X.amounts(F.col("content"))
    return B.blocks(_docs(spark, d)).withColumn("a", a).where(F.size("a") > 0).select("doc_id", "block_index", F.element_at("a", 1).alias("first_amount"), F.element_at("a", -1).alias("last_amount"), X.to_decimal(F.element_at("a", -1)).cast("double").alias("last_value"))


def q_dates(spark: SparkSession, d: str) -> DataFrame:
    """Numeric dates of blocks, normalised where that is certain."""
    raw = F.regexp_extract("content", r"([0-9]{1,4}[-./][0-9]{1,2}[-./][0-9]{1,4})", 1)
    return B.blocks(_docs(spark, d)).select("doc_id", "block_index", raw.alias("raw")).where("raw <> ''").withColumn("iso", X.iso_date(F.col("raw")))


def q_decimals(spark: SparkSession, d: str) -> DataFrame:
    """Unit prices of order lines, read in any separator style, summed per unit."""
    lines = table(spark, d, "po_master").selectExpr("inline(filter(po_lines, l -> l is not null))")
    return lines.groupBy("uom").agg(F.sum(X.to_decimal(F.col("unit_price"))).cast("decimal(38,2)").alias("total"), F.count(F.lit(1)).alias("n_lines"), F.count_if(X.to_decimal(F.col("unit_price")).isNull()).alias("n_unread"))


def q_label_values(spark: SparkSession, d: str) -> DataFrame:
    """A block that is a document's kind alone, with the block below it."""
    return B.label_values(_docs(spark, d), "^(Invoice|Rechnung|Facture|Fatura|Factura|Arve|Delivery note|Lieferschein)$")


def q_scope_fill(spark: SparkSession, d: str) -> DataFrame:
    """Blocks counted by the last heading above them."""
    s = B.scope_filled(_docs(spark, d), {"table": "^(Description|Beschreibung|Omschrijving|Descri|Kirjeldus)", "number": "(?i)(number|nummer|numero)"})
    return s.groupBy("doc_id", "scope").agg(F.count(F.lit(1)).alias("n_blocks"))


def q_look_ahead(spark: SparkSession, d: str) -> DataFrame:
    """Table heads with the first of the next five blocks that ends in a currency."""
    return B.look_ahead(_docs(spark, d), "^(Description|Beschreibung|Omschrijving|Kirjeldus)", "[A-Z]{3}$")


def q_topk_numbers(spark: SparkSession, d: str) -> DataFrame:
    """The first ten distinct document numbers of each text, sorted."""
    found = X.distinct_texts(F.regexp_extract_all("text", F.lit(f"({NUMBER})"), F.lit(1)))
    return _docs(spark, d).select("doc_id", F.concat_ws("|", F.slice(found, 1, 10)).alias("numbers"), F.size(found).alias("n_numbers"))


def q_first_blocks(spark: SparkSession, d: str) -> DataFrame:
    """How many documents start with which block."""
    return B.blocks(_docs(spark, d)).where("block_index = 0").groupBy("content").agg(F.count(F.lit(1)).alias("n_docs"))


def q_source_totals(spark: SparkSession, d: str) -> DataFrame:
    """Documents, letters and labels per source in one pass, with the whole as one more row."""
    return _docs(spark, d).rollup("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.max("n_chars").alias("longest"), F.count_if(F.coalesce("lang", F.lit("")) == "").alias("n_unlabelled"), F.grouping("source").cast("int").alias("is_total"))


def q_inventory_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts and means per document class and payable status."""
    return table(spark, d, "document_inventory").groupBy("document_class", "payable_status").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("page_count").alias("pages"), F.sum("total_words").alias("words"), F.count_if("is_multi_page").alias("n_multi_page"), F.min("file_size_bytes").alias("smallest"), F.max("file_size_bytes").alias("largest")
    )


def q_currency_rank(spark: SparkSession, d: str) -> DataFrame:
    """Currencies of orders by frequency, with each currency's three most frequent suppliers."""
    n = table(spark, d, "po_master").groupBy("currency", X.code_key(F.col("supplier_id")).alias("supplier")).agg(F.count(F.lit(1)).alias("n_orders"))
    return C.ranked(n, ["currency"], [F.desc("n_orders"), F.col("supplier").asc_nulls_last()], 3)


def q_file_filter(spark: SparkSession, d: str) -> DataFrame:
    """Files of some kinds by name, with the number in the name."""
    stem = F.regexp_replace(F.lower("filename"), r"\.[a-z]+$", "")
    return table(spark, d, "document_inventory").where(stem.rlike("^(inv|cn)-")).select("inventory_id", stem.alias("stem"), F.regexp_extract("filename", "[0-9]+", 0).cast("long").alias("number"))


def q_evidence_cache(spark: SparkSession, d: str) -> DataFrame:
    """Documents that the inventory has not read yet."""
    return B.misses(_docs(spark, d).select("doc_id", "source"), table(spark, d, "document_inventory").where("doc_id is not null"), ["doc_id"])


#: Labels of document fields, as patterns that Spark and DuckDB read alike; the first that matches names the field.
LABELS = {"total": "(?i)(total|gesamtbetrag|totaal)", "number": "(?i)(number|nummer|numero|n.mero|num.ro)$", "issued": "(?i)^(issued|ausgestellt|emitido|.tabli|opgemaakt|v.ljastatud|fecha)", "due": "(?i)^(payable|zahlbar|pagar|. r.gler|te betalen|tasuda)"}


def q_table_lines(spark: SparkSession, d: str) -> DataFrame:
    """Rows of tables in the texts."""
    return R.table_lines(B.blocks(_docs(spark, d)))


def q_fields(spark: SparkSession, d: str) -> DataFrame:
    """Labelled fields of the texts."""
    return R.labelled(B.blocks(_docs(spark, d)), LABELS)


def q_totals(spark: SparkSession, d: str) -> DataFrame:
    """Printed totals with currency, per currency: how many, how many unread, their sum."""
    code, amount = R.money(F.col("value"))
    return q_fields(spark, d).where("field = 'total'").groupBy(code.alias("currency")).agg(F.count(F.lit(1)).alias("n_totals"), F.count_if(amount.isNull()).alias("n_unread"), F.sum(amount).cast("decimal(38,2)").alias("total"))


def q_line_units(spark: SparkSession, d: str) -> DataFrame:
    """What the tables sell: lines and documents per description and currency."""
    return q_table_lines(spark, d).groupBy("description", "currency").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("doc_id").alias("n_docs"))


def q_field_consensus(spark: SparkSession, d: str) -> DataFrame:
    """What the inventory's rows of one document agree on."""
    fields = ["document_class", "payable_status", "scripts_detected", "language_hints", "po_number_candidates"]
    return C.consensus(C.observations(table(spark, d, "document_inventory"), "doc_id", fields, "inventory_id"))


QUERIES = {f.__name__: f for f in (q_blocks, q_lexicon_blocks, q_document_class, q_doc_scripts, q_amounts, q_dates, q_decimals, q_label_values, q_scope_fill, q_look_ahead, q_topk_numbers, q_first_blocks, q_source_totals, q_inventory_summary, q_currency_rank, q_file_filter, q_evidence_cache, q_table_lines, q_fields, q_totals, q_line_units, q_field_consensus)}

_B = "b as (select doc_id, i - 1 as block_index, content from (select doc_id, unnest(string_split(text, chr(10))) as content, generate_subscripts(string_split(text, chr(10)), 1) as i from documents) where trim(content) <> '')"
_COUNT = lambda p: f"len(regexp_extract_all(text, '{p}'))"
_DEC = """case when dots > 0 and commas > 0 and strpos(reverse(s), ',') < strpos(reverse(s), '.') then replace(replace(s, '.', ''), ',', '.')
    when dots > 0 and commas > 0 then replace(s, ',', '')
    when commas > 0 then replace(left(s, length(s) - strpos(reverse(s), ',')), ',', '') || '.' || right(s, strpos(reverse(s), ',') - 1)
    when dots > 1 then replace(left(s, length(s) - strpos(reverse(s), '.')), '.', '') || '.' || right(s, strpos(reverse(s), '.') - 1) else s end"""
_READ = lambda col, src: f"select *, try_cast({_DEC} as decimal(38,6)) as v from (select *, length(s) - length(replace(s, '.', '')) as dots, length(s) - length(replace(s, ',', '')) as commas from (select *, trim(regexp_replace({col}, '[$€£%]', '', 'g')) as s from {src}))"
_HEAD = "^(Description|Beschreibung|Omschrijving|Kirjeldus)"

_CELLS = rf"""{_B}, s as (select doc_id, block_index, string_split_regex(trim(content), '{R.CELLS}') as c from b), r as (select doc_id, block_index, trim(c[1]) as description, trim(c[2]) as q, trim(c[3]) as p, trim(c[4]) as a, trim(regexp_replace(c[4], '[A-Z]{{3}}', '', 'g')) as m from s where len(c) = 4),
    k as (select * from r where regexp_matches(q, '{R.NUMBER}') and regexp_matches(p, '{R.NUMBER}') and regexp_matches(m, '{R.NUMBER}') and not regexp_matches(description, '{R.NUMBER}'))"""
_num = lambda c: "cast(try_cast(" + _DEC.replace("dots", f"(length({c}) - length(replace({c}, '.', '')))").replace("commas", f"(length({c}) - length(replace({c}, ',', '')))").replace("reverse(s)", f"reverse({c})").replace("replace(s,", f"replace({c},").replace("left(s,", f"left({c},").replace("right(s,", f"right({c},").replace("length(s)", f"length({c})").replace("else s end", f"else {c} end") + " as decimal(38,6)) as double)"
_LINES = f"select doc_id, cast(block_index as int) as block_index, description, {_num('q')} as quantity, {_num('p')} as unit_price, {_num('m')} as amount, regexp_extract(a, '([A-Z]{{3}})', 1) as currency from k"
_FIELDS = f"{_B}, f as (select doc_id, cast(block_index as int) as block_index, case " + " ".join(f"when regexp_matches(left(content, strpos(content, ':') - 1), '{p}') then '{n}'" for n, p in LABELS.items()) + " end as field, trim(substring(content, strpos(content, ':') + 1)) as value from b where strpos(content, ':') > 1), g as (select * from f where field is not null and value <> '')"

SQL = {
    "q_table_lines": f"with {_CELLS} {_LINES}",
    "q_line_units": f"with {_CELLS}, l as ({_LINES}) select description, currency, count(*) as n_lines, count(distinct doc_id) as n_docs from l group by 1, 2",
    "q_fields": f"with {_FIELDS} select * from g",
    "q_totals": rf"with {_FIELDS}, t as (select regexp_extract(value, '([A-Z]{{3}})', 1) as currency, regexp_replace(regexp_replace(value, '[A-Z]{{3}}', '', 'g'), '\s', '', 'g') as n from g where field = 'total'), r as ({_READ('n', 't')}) select currency, count(*) as n_totals, count(*) filter (v is null) as n_unread, cast(sum(v) as decimal(38,2)) as total from r group by 1",
    "q_field_consensus": "with o as (" + " union all ".join(f"select doc_id as key, '{f}' as field, trim({f}) as value from document_inventory where trim({f}) <> '' and doc_id is not null" for f in ["document_class", "payable_status", "scripts_detected", "language_hints", "po_number_candidates"]) + ") select key, field, case when count(distinct value) = 1 then max(value) end as value, count(distinct value) as n_values, count(*) as n_seen from o group by 1, 2",
    "q_blocks": f"with {_B} select doc_id, cast(block_index as int) as block_index, content, doc_id || ':text:' || left(sha256(doc_id || '|text|' || content || '|' || block_index), 12) as evidence_id from b",
    "q_lexicon_blocks": f"with {_B} select doc_id, " + ", ".join(f"count(*) filter (regexp_matches(content, '{p}')) as {n}" for n, p in LEXICONS.items()) + " from b group by doc_id",
    "q_document_class": "with c as (select doc_id, " + ", ".join(f"{_COUNT(p)} as {n}" for n, p in LEXICONS.items()) + """ from documents)
        select doc_id, case when credit > 0 then 'credit' when reminder > 0 then 'reminder' when invoice > 0 then 'invoice' when delivery > 0 then 'delivery' else 'unknown' end as class,
        cast(case when credit > 0 then 2.0 when reminder > 0 then 1.75 when invoice > 0 then 1.5 when delivery > 0 then 1.0 else 0.0 end as double) as score from c""",
    "q_doc_scripts": "select doc_id, " + ", ".join(f"{_COUNT(p)} as {n}" for n, p in SCRIPTS.items()) + " from documents",
    "q_amounts": f"""with {_B}, a as (select doc_id, block_index, regexp_extract_all(content, '{X.AMOUNT}') as a from b), l as (select doc_id, block_index, a[1] as first_amount, a[-1] as last_amount from a where len(a) > 0)
        select doc_id, cast(block_index as int) as block_index, first_amount, last_amount, cast(v as double) as last_value from ({_READ('last_amount', 'l')})""",
    "q_dates": rf"""with {_B}, r as (select doc_id, block_index, regexp_extract(content, '([0-9]{{1,4}}[-./][0-9]{{1,2}}[-./][0-9]{{1,4}})', 1) as raw from b),
        p as (select *, string_split_regex(raw, '[-./]') as q from r where raw <> ''), n as (select *, try_cast(q[1] as int) as c, try_cast(q[2] as int) as d, try_cast(q[3] as int) as e from p)
        select doc_id, cast(block_index as int) as block_index, raw, case when length(q[1]) = 4 and length(q[3]) <= 2 and d between 1 and 12 and e between 1 and 31 then q[1] || '-' || lpad(q[2], 2, '0') || '-' || lpad(q[3], 2, '0')
        when length(q[3]) = 4 and length(q[1]) <= 2 and c > 12 and c <= 31 and d between 1 and 12 then q[3] || '-' || lpad(q[2], 2, '0') || '-' || lpad(q[1], 2, '0')
        when length(q[3]) = 4 and length(q[1]) <= 2 and d > 12 and d <= 31 and c between 1 and 12 then q[3] || '-' || lpad(q[1], 2, '0') || '-' || lpad(q[2], 2, '0') end as iso from n""",
    "q_decimals": f"with l as (select l.uom as uom, l.unit_price as unit_price from (select unnest(po_lines) as l from po_master) where l is not null), r as ({_READ('unit_price', 'l')}) select uom, cast(sum(v) as decimal(38,2)) as total, count(*) as n_lines, count(*) filter (v is null) as n_unread from r group by uom",
    "q_label_values": f"with {_B}, n as (select *, lead(content) over (partition by doc_id order by block_index) as value from b) select doc_id, cast(block_index as int) as block_index, trim(content) as label, value from n where regexp_matches(content, '^(Invoice|Rechnung|Facture|Fatura|Factura|Arve|Delivery note|Lieferschein)$') and value is not null",
    "q_scope_fill": f"""with {_B}, h as (select *, case when regexp_matches(content, '^(Description|Beschreibung|Omschrijving|Descri|Kirjeldus)') then 'table' when regexp_matches(content, '(?i)(number|nummer|numero)') then 'number' end as h from b),
        s as (select doc_id, last_value(h ignore nulls) over (partition by doc_id order by block_index) as scope from h) select doc_id, scope, count(*) as n_blocks from s group by all""",
    "q_look_ahead": f"""with {_B}, n as (select *, row_number() over (partition by doc_id order by block_index) as r from b), l as (select * from n where regexp_matches(content, '{_HEAD}'))
        select l.doc_id, cast(l.block_index as int) as block_index, cast(min(n.block_index) as int) as found_index, min_by(n.content, n.block_index) as found from l left join n on n.doc_id = l.doc_id and n.r between l.r + 1 and l.r + 5 and regexp_matches(n.content, '[A-Z]{{3}}$') group by 1, 2""",
    "q_topk_numbers": f"with f as (select doc_id, list_sort(list_distinct(regexp_extract_all(text, '{NUMBER}'))) as f from documents) select doc_id, array_to_string(f[1:10], '|') as numbers, cast(len(f) as int) as n_numbers from f",
    "q_first_blocks": f"with {_B} select content, count(*) as n_docs from b where block_index = 0 group by content",
    "q_source_totals": "select source, count(*) as n_docs, cast(sum(n_chars) as bigint) as n_chars, max(n_chars) as longest, count(*) filter (coalesce(lang, '') = '') as n_unlabelled, cast(grouping(source) as int) as is_total from documents group by rollup(source)",
    "q_inventory_summary": "select document_class, payable_status, count(*) as n_files, cast(sum(page_count) as bigint) as pages, cast(sum(total_words) as bigint) as words, count(*) filter (is_multi_page) as n_multi_page, min(file_size_bytes) as smallest, max(file_size_bytes) as largest from document_inventory group by all",
    "q_currency_rank": r"with n as (select currency, regexp_replace(supplier_id, '^[\s\pZ]+|[\s\pZ]+$', '', 'g') as supplier, count(*) as n_orders from po_master group by all), r as (select *, cast(row_number() over (partition by currency order by n_orders desc, supplier nulls last) as int) as rank from n) select currency, supplier, n_orders, rank from r where rank <= 3",
    "q_file_filter": r"select inventory_id, regexp_replace(lower(filename), '\.[a-z]+$', '') as stem, cast(regexp_extract(filename, '[0-9]+') as bigint) as number from document_inventory where regexp_matches(regexp_replace(lower(filename), '\.[a-z]+$', ''), '^(inv|cn)-')",
    "q_evidence_cache": "select doc_id, source from documents where doc_id not in (select doc_id from document_inventory where doc_id is not null)",
}
