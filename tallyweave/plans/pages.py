"""Queries on pages, logical documents, assemblies and findings, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators import issues as I
from tallyweave.operators import nested
from tallyweave.operators import pages as P
from tallyweave.sources.tables import table

# Words that tell what a page is, as patterns that Spark and DuckDB read alike.
WORDS = {
    "title": "(?i)(tax invoice|commercial invoice|^invoice$|rechnung$|steuerrechnung|^facture$|^fatura$|^factura$|^factuur$|^arve$|ใบกำกับภาษี)",
    "meta": "(?i)(invoice (no|nr|number|date)|rechnungsdatum|rechnungsnummer|billed? to|due date|payment terms|zahlungsziel|document number|belegnummer|data de vencimento|maksetaehtaeg|payable by|zahlbar bis)",
    "credit": "(?i)(credit (memo|note)|gutschrift|note de cr.dit|nota de cr.dito|creditnota|kreeditarve)",
    "debit": "(?i)(debit (memo|note)|lastschrift|note de d.bit|nota de d.bito)",
    "order": "(?i)(^purchase order$|^bestellung$|bon de commande|orden de compra|purchase order (form|summary))",
    "supporting": "(?i)(packing list|packliste|lieferschein|delivery (note|slip)|bon de livraison|guia de remessa|albar.n|pakbon|saateleht|bill of lading|certificate of origin|gross weight|net weight)",
    "receipt": "(?i)(cash receipt|sales receipt|payment receipt|quittung|kassenbon|^recibo$|kuitansi)",
    "remittance": "(?i)(remittance (advice|slip|notice)|payment advice|avis de (virement|paiement)|.berweisungsbeleg|comprovante)",
    "payable": "(?i)(amount due|balance due|endbetrag|gesamtsumme|gesamtbetrag|zu zahlen|total a pagar|montant total|net to pay|grand total|te betalen|tasuda kokku)",
    "tax": r"(?i)(\bvat\b|mwst|\biva\b|\btva\b|\bgst\b|\bsst\b|\btax\b|withholding|reverse charge|k.ibemaks|\bbtw\b|steuer)",
    "line": "(?i)(unit price|quantity|\\bqty\\b|einzelpreis|menge|gesamtpreis|pre.o unit.rio|quantidade|prix unitaire|quantit.|stukprijs|aantal|precio unitario|cantidad|.hiku hind|kogus)",
}
PAGE = "(?i)(?:page|seite|folha|p.gina|pagina|lk) ([0-9]+) ?(?:of|von|sur|de|van|/) ?([0-9]+)"
KEYWORD = "(?i)(continued|continuation|fortsetzung|folgeblatt|continua..o|carry forward|.bertrag)"
NUMBER = "[A-Z]{1,3}[-/ ]?[0-9]{4,6}|20[0-9]{2}/[0-9]{4,6}"
STOP = ["INVOICE", "DATE", "PAGE", "TOTAL", "NUMBER"]
CURRENCY = "(EUR|USD|GBP|GHS|MYR|ZAR|THB|CHF)"


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return P.classified(P.pages(table(spark, d, "documents")), WORDS, PAGE, KEYWORD)


def q_page_classes(spark: SparkSession, d: str) -> DataFrame:
    """Role and relevance of every page."""
    return _classified(spark, d).select("doc_id", "page_no", "current", "total", "continues", "role", "relevance")


def q_page_roles(spark: SparkSession, d: str) -> DataFrame:
    """Pages and documents per role and relevance."""
    return _classified(spark, d).groupBy("role", "relevance").agg(F.count(F.lit(1)).alias("n_pages"), F.count_distinct("doc_id").alias("n_docs"))


def q_page_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Document numbers on every page that has any."""
    df = P.pages(table(spark, d, "documents")).select("doc_id", "page_no", P.numbers_of("lines", NUMBER, STOP).alias("n"))
    return df.where(F.size("n") > 0).select("doc_id", "page_no", F.array_join("n", "|").alias("numbers"))


def _grouped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Pages with what is read off them, and their groups."""
    text = F.array_join("lines", "\n")
    df = _classified(spark, d).withColumns({"numbers": P.numbers_of("lines", NUMBER, STOP), "currency": F.regexp_extract(text, CURRENCY, 1)})
    one = F.struct("page_no", "numbers", "current", "total", (F.col("role") == "continuation").alias("continues"))
    return df, P.grouped(df.groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("pages")))


def q_page_groups(spark: SparkSession, d: str) -> DataFrame:
    """Pages put together into logical documents."""
    return _grouped(spark, d)[1].select("doc_id", "page_no", "group_no", "score")


def q_assemblies(spark: SparkSession, d: str) -> DataFrame:
    """Logical documents put together into financial documents: what begins one, continues it or supports it."""
    df, groups = _grouped(spark, d)
    g = df.join(groups, ["doc_id", "page_no"]).groupBy("doc_id", "group_no").agg(
        F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"), F.min_by("role", "page_no").alias("role"), F.min_by("relevance", "page_no").alias("relevance"),
        F.min_by(F.try_element_at("numbers", F.lit(1)), F.when(F.size("numbers") > 0, F.col("page_no"))).alias("number"), F.min_by("currency", F.when(F.col("currency") != "", F.col("page_no"))).alias("currency"),
        (F.max("payable") > 0).alias("totals"), F.bool_or("by_number").alias("shared"), F.count_if("by_continuation").alias("links"),
    )
    one = F.struct("group_no", "first_page", "last_page", "role", "relevance", "number", "currency", "totals", "shared", "links")
    return P.assembled(g.groupBy("doc_id").agg(F.collect_list(one).alias("groups")))


def q_merged_versions(spark: SparkSession, d: str) -> DataFrame:
    """What the first version of a supplier says, completed by later ones, and where those differ."""
    return P.merged(table(spark, d, "suppliers").where("supplier_id is not null"), ["supplier_id"], "supplier_row_id", ["name", "vat_id", "country", "email", "bank_iban"])


def q_appended_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order's first delivery with those of later ones that it did not hold, per order."""
    lines = nested.order_lines(table(spark, d, "po_master")).where("po_id is not null")
    first = table(spark, d, "po_master").where("po_id is not null").groupBy("po_id").agg(F.min("po_row_id").alias("_first"))
    lines = lines.join(first, "po_id").select("po_id", "row_id", "line_id", "description", "unit_price", "_first")
    parts = [lines.where(c).drop("_first") for c in ("row_id = _first", "row_id <> _first")]
    return P.appended(*parts, ["po_id", "line_id", "description", "unit_price"]).groupBy("po_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("row_id").alias("n_deliveries"))


#: What is asked of an inventoried file, in order; the first two kinds of files are asked nothing else.
CHECKS = [
    I.Check("RELEVANCE_SUPPORTING_DOCUMENT", "INFO", "relevance", "document_class = 'delivery_note'", True),
    I.Check("RELEVANCE_NON_PAYABLE", "INFO", "relevance", "payable_status = 'likely_non_payable'", True),
    I.Check("RELEVANCE_AMBIGUOUS", "WARNING", "relevance", "payable_status = 'uncertain'"),
    I.Check("IDENTITY_NO_EVIDENCE", "BLOCKING", "identity", "coalesce(trim(invoice_number_candidates), '') = '' and coalesce(trim(date_candidates), '') = '' and coalesce(trim(currency_candidates), '') = ''", True),
    I.Check("IDENTITY_MISSING_INVOICE_NUMBER", "WARNING", "invoice_number", "coalesce(trim(invoice_number_candidates), '') = ''"),
    I.Check("IDENTITY_MISSING_DATE", "INFO", "invoice_date", "coalesce(trim(date_candidates), '') = ''"),
    I.Check("CURRENCY_MISSING", "WARNING", "currency", "coalesce(trim(currency_candidates), '') = ''"),
    I.Check("FINANCIALS_EMPTY", "BLOCKING", "financials", "coalesce(total_words, 0) = 0"),
    I.Check("SEMANTIC_ROLE_UNKNOWN", "INFO", "document_class", "coalesce(document_class, 'unknown') = 'unknown'"),
    I.Check("PAGES_MISMATCH", "ERROR", "page_count", "is_multi_page and page_count < 2 or not is_multi_page and page_count > 1"),
    I.Check("SIZE_IMPLAUSIBLE", "ERROR", "file_size_bytes", "file_size_bytes <= 0 or file_size_bytes < total_characters"),
]


def _issues(spark: SparkSession, d: str) -> DataFrame:
    return I.issues(table(spark, d, "document_inventory"), "inventory_id", CHECKS)


def q_issues(spark: SparkSession, d: str) -> DataFrame:
    """Findings about inventoried files, in order."""
    return I.ordered(_issues(spark, d), ["inventory_id"]).select("inventory_id", "code", "severity", "field", "position")


def q_issue_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """What follows for every file by its gravest finding, with counts by severity."""
    return I.verdicts(table(spark, d, "document_inventory"), "inventory_id", _issues(spark, d))


def q_issue_fields(spark: SparkSession, d: str) -> DataFrame:
    """Findings that matter (warnings and graver) per field and severity."""
    return _issues(spark, d).where("rank <= 2").groupBy("field", "severity").agg(F.count(F.lit(1)).alias("n_issues"), F.count_distinct("inventory_id").alias("n_files"))


QUERIES = {f.__name__: f for f in (q_page_classes, q_page_roles, q_page_numbers, q_page_groups, q_assemblies, q_merged_versions, q_appended_lines, q_issues, q_issue_verdicts, q_issue_fields)}

_PAGES = "pg as (select doc_id, unnest(string_split(text, chr(10) || chr(10))) as page, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) as page_no from documents where text is not null)"
_LINES = f"{_PAGES}, ln as (select doc_id, page_no, unnest(string_split(page, chr(10))) as line, generate_subscripts(string_split(page, chr(10)), 1) as i from pg)"
_q = lambda s: s.replace("'", "''")
_CLASSES = f"""{_LINES}, ct as (select doc_id, page_no, {', '.join(f"count(*) filter (regexp_matches(line, '{_q(p)}')) as {k}" for k, p in WORDS.items())},
  arg_max(line, i) filter (regexp_matches(line, '{PAGE}')) as pm, coalesce(bool_or(try_cast(regexp_extract(line, '{PAGE}', 1) as int) > 1), false) or count(*) filter (regexp_matches(line, '{KEYWORD}')) > 0 as continues from ln group by 1, 2),
iv as (select *, title > 0 or meta > 0 or (tax > 0 and line > 0) as inv from ct),
rl as (select *, case when credit > 0 then 'credit_memo' when debit > 0 then 'debit_memo' when "order" > 0 and not inv then 'purchase_order' when receipt > 0 and not inv then 'receipt' when remittance > 0 and not inv then 'remittance'
  when continues and not (title > 0 and meta > 0) then 'continuation' when supporting > 0 and not inv then 'supporting_document' when inv then 'invoice' when supporting > 0 then 'supporting_document' else 'unknown' end as role from iv),
cl as (select doc_id, cast(page_no as int) as page_no, try_cast(regexp_extract(pm, '{PAGE}', 1) as int) as current, try_cast(regexp_extract(pm, '{PAGE}', 2) as int) as total, continues, role,
  case when role in ('purchase_order', 'receipt', 'remittance') then 'non_payable' when payable > 0 then 'payable_candidate' when role in ('invoice', 'credit_memo', 'debit_memo') and tax > 0 and line > 0 then 'payable_candidate'
  when role in ('supporting_document', 'continuation') then 'supporting' else 'ambiguous' end as relevance from rl)"""
_CLASSES = _CLASSES.replace(') as order,', ') as "order",')

def _asked(i: int) -> str:
    """SQL: the condition under which check i is asked and finds something."""
    before = [c for c in CHECKS[:i] if c.ends]
    return f"coalesce({CHECKS[i].when}, false)" + "".join(f" and not coalesce({c.when}, false)" for c in before)


_FOUND = "fo as (" + " union all ".join(f"select inventory_id, '{c.code}' as code, '{c.severity}' as severity, {list(I.SEVERITIES).index(c.severity)} as rank, '{c.field}' as field, {i} as place from document_inventory where {_asked(i)}" for i, c in enumerate(CHECKS)) + ")"
_MERGED = ["name", "vat_id", "country", "email", "bank_iban"]

SQL = {
    "q_page_classes": f"with {_CLASSES} select * from cl",
    "q_page_roles": f"with {_CLASSES} select role, relevance, count(*) as n_pages, count(distinct doc_id) as n_docs from cl group by 1, 2",
    "q_page_numbers": f"with {_LINES}, n as (select doc_id, page_no, unnest(regexp_extract_all(line, '{NUMBER}')) as n from ln), k as (select distinct * from n where length(n) >= 3 and regexp_matches(n, '[0-9]') and upper(n) not in ({', '.join(repr(s) for s in STOP)})) select doc_id, cast(page_no as int) as page_no, string_agg(n, '|' order by n) as numbers from k group by 1, 2",
    "q_merged_versions": "with o as (" + " union all ".join(f"select supplier_id, supplier_row_id as r, '{f}' as field, trim({f}) as value from suppliers where trim({f}) <> '' and supplier_id is not null" for f in _MERGED)
    + "), f as (select *, first_value(value) over (partition by supplier_id, field order by r) as v from o) select supplier_id, field, min(v) as value, cast(count(*) filter (upper(value) <> upper(v)) as int) as n_conflicts, coalesce(string_agg(r || ':' || value, '|' order by r) filter (upper(value) <> upper(v)), '') as conflicts from f group by 1, 2",
    "q_appended_lines": """with l as (select po_id, po_row_id as row_id, unnest(po_lines) as l, min(po_row_id) over (partition by po_id) as f from po_master where po_id is not null), k as (select po_id, row_id, f, l.line_id as line_id, l.description as description, l.unit_price as unit_price from l where l is not null),
        a as (select * from k where row_id = f), s as (select distinct po_id, line_id, description, unit_price from a),
        b as (select * from k where row_id <> f and not exists (select 1 from s where s.po_id = k.po_id and s.line_id is not distinct from k.line_id and s.description is not distinct from k.description and s.unit_price is not distinct from k.unit_price))
        select po_id, count(*) as n_lines, count(distinct row_id) as n_deliveries from (select * from a union all select * from b) group by 1""",
    "q_issues": f"with {_FOUND} select inventory_id, code, severity, field, cast(row_number() over (partition by inventory_id order by field, rank, code, place) as int) as position from fo",
    "q_issue_verdicts": f"with {_FOUND} select i.inventory_id, case min(rank) when 0 then 'BLOCKED' when 1 then 'INVALID' when 2 then 'WARNING' else 'VALID' end as status, {', '.join(f"count(code) filter (severity = '{s}') as n_{s.lower()}" for s in I.SEVERITIES)} from document_inventory i left join fo using (inventory_id) group by 1",
    "q_issue_fields": f"with {_FOUND} select field, severity, count(*) as n_issues, count(distinct inventory_id) as n_files from fo where rank <= 2 group by 1, 2",
}
