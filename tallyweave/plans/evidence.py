"""Queries on evidence, extraction, scalars and sources, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import text as X
from tallyweave.operators import blocks as B
from tallyweave.operators import consensus as C
from tallyweave.operators import extract as R
from tallyweave.operators import matching as M
from tallyweave.operators import nested
from tallyweave.plans import masters, texts
from tallyweave.sources.tables import table

COLUMNS = "(?i)(description|quantity|unit price|amount|beschreibung|menge|einzelpreis|betrag|omschrijving|aantal|stukprijs|bedrag|descripci.n|cantidad|precio|importe|kirjeldus|kogus|hind|summa)"
TOTAL = "(?i)(total|gesamtbetrag|totaal|kokku)"
TAX = "(?i)(vat|tax|levy|mwst|tva|iva|btw)"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def q_table_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the table below the first head of a text, above its total, numbered."""
    return R.table_rows(B.blocks(_docs(spark, d)), COLUMNS, TOTAL, TAX).select("doc_id", "block_index", "line_no", F.size("cells").alias("n_cells"), F.element_at("cells", 1).alias("first_cell"))


def q_key_fields(spark: SparkSession, d: str) -> DataFrame:
    return R.key_fields(_docs(spark, d), R.KEY_FIELDS)


def q_item_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Order lines that are goods and that are services, per unit."""
    return nested.order_lines(table(spark, d, "po_master")).groupBy("uom", X.item_kind(F.col("description")).alias("item_type")).agg(F.count(F.lit(1)).alias("n_lines"))


def q_order_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Order numbers without what leads them."""
    return table(spark, d, "po_master").select("po_row_id", X.without_order_prefix(F.concat(F.when(F.col("currency") == "EUR", "PO: ").when(F.col("currency") == "USD", "Purchase Order #").otherwise("# "), "po_number")).alias("number"))


def q_tax_names(spark: SparkSession, d: str) -> DataFrame:
    """Names and kinds of the texts' tax rows."""
    b = B.blocks(_docs(spark, d)).where(F.col("content").rlike(TAX) & F.col("content").rlike("[0-9]"))
    return b.select(X.tax_name(F.col("content")).alias("tax_name")).select("tax_name", X.tax_kind(F.col("tax_name")).alias("tax_type")).groupBy("tax_name", "tax_type").agg(F.count(F.lit(1)).alias("n_rows"))


def q_rates(spark: SparkSession, d: str) -> DataFrame:
    """Tax rates of order lines written with a sign, with blanks and as something else, read again."""
    pct = F.format_string("%.1f", F.col("l_tax") * 100)
    text = F.when(F.col("l_returnflag") == "A", F.concat(pct, F.lit(" %"))).when(F.col("l_returnflag") == "N", F.concat(F.lit(" "), pct, F.lit("%"))).otherwise(F.concat(F.lit("x"), pct))
    return table(spark, d, "lineitem").groupBy(X.rate_value(text).alias("rate")).agg(F.count(F.lit(1)).alias("n_lines"))


def q_text_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Words and letters of every text."""
    return _docs(spark, d).select("doc_id", X.n_words(F.col("text")).alias("n_words"), X.n_letters(F.col("text")).alias("n_letters"))


def q_text_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Pages with text of their own (20 letters at least) and their share, per source."""
    n = F.size(F.split("text", "\n\n"))
    native = F.size(F.filter(F.split("text", "\n\n"), lambda p: X.n_letters(p) >= 20))
    return _docs(spark, d).where("text is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(n).alias("n_pages"), F.sum(native).alias("n_native"), F.count_if(native == n).alias("n_readable"), (F.sum(native) / F.sum(n)).alias("coverage"))


def q_full_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts put together again from their blocks, in order."""
    b = B.blocks(_docs(spark, d)).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("block_index", "content"))).alias("b"))
    return b.select("doc_id", F.md5(F.array_join(F.transform("b", lambda x: x["content"]), "\n")).alias("digest"), F.size("b").alias("n_blocks"))


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence ids of observed suppliers with their parts."""
    ids = table(spark, d, "observed_supplier_identity").select("obs_id", "doc_id", F.explode("evidence_ids").alias("evidence_id"))
    part = lambda k: F.try_element_at(F.split("evidence_id", ":"), F.lit(k))
    return ids.select("obs_id", "doc_id", "evidence_id", F.regexp_extract(part(1), "[0-9]+", 0).try_cast("long").alias("seen_in"), F.regexp_extract(part(2), "[0-9]+", 0).try_cast("int").alias("page"), X.source_key(part(3)).alias("source"), part(4).alias("digest"))


def q_evidence_sources(spark: SparkSession, d: str) -> DataFrame:
    """Evidence per source and page, with how many ids do not keep the contract: a source of the list and twelve hexadecimal digits."""
    ok = F.col("source").isNotNull() & F.coalesce(F.col("digest").rlike("^[0-9a-f]{12}$"), F.lit(False))
    return _evidence(spark, d).groupBy("source", "page").agg(F.count(F.lit(1)).alias("n_ids"), F.count_if(~ok).alias("n_broken"), F.count_distinct("seen_in").alias("n_docs"))


def q_evidence_order(spark: SparkSession, d: str) -> DataFrame:
    """Evidence of an observation in its stable order: page, source, id."""
    one = F.array_sort(F.collect_list(F.struct("page", "source", "evidence_id")))
    return _evidence(spark, d).groupBy("obs_id").agg(one.alias("e")).select("obs_id", F.array_join(F.transform("e", lambda x: x["evidence_id"]), "|").alias("ids"), F.element_at("e", 1)["page"].alias("first_page"))


def q_evidence_union(spark: SparkSession, d: str) -> DataFrame:
    return C.evidence_union(table(spark, d, "observed_supplier_identity"), "doc_id", "evidence_ids").select("doc_id", "n_ids", F.array_join("ids", "|").alias("ids"))


def q_fact_counts(spark: SparkSession, d: str) -> DataFrame:
    """Facts of every observation and distinct evidence behind them."""
    o = table(spark, d, "observed_supplier_identity")
    facts = sum((F.when(F.trim(c) != "", 1).otherwise(0) for c in ("name", "vat_id", "country", "email", "bank_iban", "address")), F.lit(0))
    return o.select("obs_id", facts.alias("n_facts"), F.coalesce(F.size(F.array_distinct("evidence_ids")), F.lit(0)).alias("n_evidence"))


def q_value_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Values on which the rows of a supplier differ, with the rows that say each."""
    return C.value_evidence(C.observations(table(spark, d, "suppliers"), "supplier_id", ["name", "vat_id", "country", "email", "bank_iban"], "supplier_row_id"))


def q_class_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Class of every document by its inventory rows, those of one page first."""
    return C.priority_consensus(table(spark, d, "document_inventory"), "doc_id", "document_class", F.col("page_count") == 1, "unknown")


def q_currency_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers whose orders name several currencies."""
    o = table(spark, d, "po_master").select(X.code_key(F.col("supplier_id")).alias("supplier_id"), X.currency_key(F.col("currency")).alias("currency")).where("supplier_id <> '' and currency <> ''").distinct()
    return o.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("n_currencies"), F.array_join(F.array_sort(F.collect_list("currency")), "|").alias("currencies")).where("n_currencies > 1")


def q_key_differences(spark: SparkSession, d: str) -> DataFrame:
    """Line ids that the last delivery of an order lacks and those it adds to the first."""
    p = table(spark, d, "po_master").where("po_id is not null").select("po_id", "po_row_id", F.expr("array_sort(array_distinct(filter(transform(coalesce(po_lines, array()), l -> l.line_id), x -> x is not null)))").alias("ids"))
    g = p.groupBy("po_id").agg(F.min_by("ids", "po_row_id").alias("a"), F.max_by("ids", "po_row_id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return g.select("po_id", F.array_join(F.array_except("a", "b"), "|").alias("missing"), F.array_join(F.array_except("b", "a"), "|").alias("unexpected"))


def q_acquired(spark: SparkSession, d: str) -> DataFrame:
    """Where the text of each document comes from: the inventory's cache, or still to be read."""
    docs, cache = _docs(spark, d).select("doc_id"), table(spark, d, "document_inventory").where("doc_id is not null").select("doc_id", "total_characters").groupBy("doc_id").agg(F.max("total_characters").alias("n_chars"))
    hits = docs.join(cache, "doc_id").select("doc_id", F.lit("cache").alias("origin"), "n_chars")
    return hits.unionByName(B.misses(docs, cache, ["doc_id"]).select("doc_id", F.lit("read").alias("origin"), F.lit(None).cast("long").alias("n_chars")))


#: Recognition models by language; others take the last one.
MODELS = {"en": "latin", "de": "latin", "fr": "latin", "pt": "latin", "es": "latin", "nl": "latin", "et": "latin", "th": "thai", "": "default"}


def q_models(spark: SparkSession, d: str) -> DataFrame:
    """Documents per model that their language calls for."""
    models = spark.createDataFrame(list(MODELS.items()), "code string, model string")
    lang = F.lower(F.substring(F.coalesce(X.code_key(F.col("lang")), F.lit("")), 1, 2))
    df = _docs(spark, d).select(lang.alias("code")).join(models, "code", "left")
    return df.groupBy(F.coalesce("model", F.lit("default")).alias("model")).agg(F.count(F.lit(1)).alias("n_docs"))


PO_RULES = {
    "id_required": "trim(po_id) <> ''", "number_required": "trim(po_number) <> ''", "supplier_required": "trim(supplier_id) <> ''", "currency_three_letters": "currency rlike '^[A-Z]{3}$'", "lines_required": "size(filter(coalesce(po_lines, array()), l -> l is not null)) > 0",
    "no_null_lines": "not exists(coalesce(po_lines, array()), l -> l is null)", "line_ids_unique": "size(array_distinct(transform(filter(coalesce(po_lines, array()), l -> l.line_id is not null), l -> l.line_id))) = size(filter(coalesce(po_lines, array()), l -> l.line_id is not null))",
    "quantities_positive": "not exists(filter(coalesce(po_lines, array()), l -> l is not null), l -> coalesce(l.quantity, 0) <= 0)", "created_before_loaded": "created_at <= loaded_at",
}


def q_po_violations(spark: SparkSession, d: str) -> DataFrame:
    """Rules that orders break, per rule and currency."""
    o = table(spark, d, "po_master")
    return M.violations(o, "po_row_id", PO_RULES).join(o.select("po_row_id", "currency"), "po_row_id").groupBy("rule", "currency").agg(F.count(F.lit(1)).alias("n_orders"))


def q_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as JSON and read again: all come back as they were."""
    o = table(spark, d, "po_master").select("po_row_id", "currency", F.struct("po_id", "po_number", "supplier_id", "po_lines").alias("x"))
    back = F.from_json(F.to_json("x", {"ignoreNullFields": "false"}), o.schema["x"].dataType)
    same = F.to_json(back, {"ignoreNullFields": "false"}) == F.to_json("x", {"ignoreNullFields": "false"})
    return o.groupBy("currency").agg(F.count(F.lit(1)).alias("n_orders"), F.count_if(~same).alias("n_changed"))


def q_markdown_rows(spark: SparkSession, d: str) -> DataFrame:
    """Table rows of texts that are written with bars, as a vision model answers: three cells at least and no word of a head in the first two."""
    b = B.blocks(_docs(spark, d)).where(F.col("content").contains("|"))
    c = b.select("doc_id", "block_index", F.transform(F.split(F.btrim("content", F.lit("| ")), "[|]"), lambda x: F.trim(x)).alias("c")).where("size(c) >= 3")
    head = F.exists(F.slice("c", 1, 2), lambda x: x.rlike(COLUMNS))
    last = F.regexp_extract(F.element_at("c", -1), r"([0-9]+(?:[.,][0-9]{3})*[.,][0-9]{2})", 1)
    return c.where(~head).select("doc_id", "block_index", F.element_at("c", 1).alias("description"), F.when(F.element_at("c", 2).rlike(r"^[0-9]+(?:[.,][0-9]+)?$"), F.element_at("c", 2)).alias("quantity"), X.to_decimal(last).cast("double").alias("amount"))


def q_plain_names(spark: SparkSession, d: str) -> DataFrame:
    """Names without accents, and how many spellings each stands for."""
    return table(spark, d, "suppliers").where("name is not null").groupBy(F.lower(X.unaccented(F.col("name"))).alias("plain")).agg(F.count_distinct("name").alias("n_spellings"), F.count(F.lit(1)).alias("n_rows"))


def q_currency_context(spark: SparkSession, d: str) -> DataFrame:
    """Currencies of inventoried files, signs told by the file's other candidates and hints."""
    inv = table(spark, d, "document_inventory").where("currency_candidates is not null")
    sign = F.regexp_extract("currency_candidates", "([A-Z]{3}|[$€£])", 1)
    df = inv.select("inventory_id", sign.alias("sign"), F.concat_ws(" ", "currency_candidates", "language_hints").alias("context")).where("sign <> ''")
    return df.select("inventory_id", "sign", X.currency_in_context(F.col("sign"), F.col("context")).alias("currency"))


def q_image_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Width and height read from image headers, made here of each part's size and id; every other one is no image."""
    four = lambda c: F.lpad(F.hex(F.col(c)), 8, "0")
    mark = F.when(F.col("p_size") < 40, "89504E470D0A1A0A").otherwise("FFD8FFE000104A46")
    p = table(spark, d, "part").select("p_partkey", F.unhex(F.concat(mark, F.lit("0000000D49484452"), four("p_size"), four("p_partkey"))).alias("content"))
    return p.select("p_partkey", X.png_size(F.col("content")).alias("s")).select("p_partkey", "s.width", "s.height")


def q_file_parts(spark: SparkSession, d: str) -> DataFrame:
    """Kind and number of a document from its file's name, the first number being the page where there are two."""
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    return table(spark, d, "document_inventory").where("filename is not null").select("inventory_id", F.upper(F.regexp_extract(stem, "^([A-Za-z]+)", 1)).alias("kind"), F.regexp_extract(stem, "([0-9]+)$", 1).try_cast("long").alias("number"), F.length(stem).alias("n_stem"))


def q_first_files(spark: SparkSession, d: str) -> DataFrame:
    """The first ten files by name in lower case: what a run with a limit takes."""
    return table(spark, d, "document_inventory").where("filename is not null").select("filename").distinct().orderBy(F.lower("filename"), "filename").limit(10)


def q_first_lines(spark: SparkSession, d: str) -> DataFrame:
    """The first three blocks of every text, and the first number that they hold."""
    b = F.slice(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), 1, 3)
    return _docs(spark, d).where("text is not null").select("doc_id", F.array_join(b, " / ").alias("head"), F.regexp_extract(F.array_join(b, " / "), "([0-9]+)", 1).alias("number"))


def q_confidences(spark: SparkSession, d: str) -> DataFrame:
    """Mean, least, greatest confidence and share of low ones per source and language; confidence from the block's length."""
    b = B.blocks(_docs(spark, d)).join(_docs(spark, d).select("doc_id", "source"), "doc_id")
    c = F.round(1 - 1 / (F.length("content") + 1), 3)
    return b.select("source", c.alias("c")).groupBy("source").agg(F.round(F.avg("c"), 6).alias("mean"), F.min("c").alias("least"), F.max("c").alias("greatest"), F.round(F.avg(F.when(F.col("c") < 0.9, 1.0).otherwise(0.0)), 6).alias("low_share"))


def q_inventory_totals(spark: SparkSession, d: str) -> DataFrame:
    """All figures of the inventory in one row."""
    has = lambda c: F.count_if(F.coalesce(F.trim(c), F.lit("")) != "")
    return table(spark, d, "document_inventory").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("filename").alias("n_files"), F.sum("page_count").alias("n_pages"), F.count_if("is_multi_page").alias("n_multi_page"), F.count_if(F.expr("not is_multi_page")).alias("n_single_page"),
        F.max("page_count").alias("most_pages"), F.sum("file_size_bytes").alias("n_bytes"), F.sum("total_words").alias("n_words"), F.sum("total_characters").alias("n_chars"), F.count_if(F.expr("total_characters < 20")).alias("n_without_text"),
        has("currency_candidates").alias("with_currency"), has("invoice_number_candidates").alias("with_number"), has("date_candidates").alias("with_date"), has("po_number_candidates").alias("with_order"), F.count_if(F.expr("payable_status = 'likely_payable'")).alias("n_payable"), F.count_distinct("document_class").alias("n_classes"),
    )


def q_run_summary(spark: SparkSession, d: str) -> DataFrame:
    """Every delivery of the feed read on its own: one that fails is counted as failed and stops no other."""
    status = F.when(F.col("payload").isNull() | (F.trim("payload") == ""), "empty").when(F.expr(f"try_parse_json(concat('[', payload, ',\"{nested.END}\"]')) is null"), "failed").otherwise("read")
    return table(spark, d, "master_feed").select("master_name", status.alias("status"), F.length("payload").alias("n")).groupBy("master_name", "status").agg(F.count(F.lit(1)).alias("n_deliveries"), F.sum("n").alias("n_chars"))


def q_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All that texts offer, in one long table: key fields, labelled fields and table lines."""
    b = B.blocks(_docs(spark, d))
    parts = [R.key_fields(_docs(spark, d), R.KEY_FIELDS).select("doc_id", F.lit("key").alias("kind"), "field", "value"), R.labelled(b, texts.LABELS).select("doc_id", F.lit("label").alias("kind"), "field", "value"), R.table_lines(b).select("doc_id", F.lit("line").alias("kind"), F.lit("description").alias("field"), F.col("description").alias("value"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_identities(spark: SparkSession, d: str) -> DataFrame:
    """Observed suppliers as the keys they are matched by, with how many of them are known."""
    k = masters.supplier_keys(table(spark, d, "observed_supplier_identity"), "obs_id", "obs_id")
    return k.withColumn("n_known", sum((F.when(F.col(c) != "", 1).otherwise(0) for c in ("vat", "name", "email", "iban")), F.lit(0)))


def q_normal_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with what their lines lack: lines, numbers, quantities and prices that are missing or unreadable, and the currency."""
    lines = F.expr("filter(coalesce(po_lines, array()), l -> l is not null)")
    lack = lambda f: F.size(F.filter(lines, f))
    return table(spark, d, "po_master").select(
        "po_row_id", F.size(lines).alias("n_lines"), lack(lambda x: F.coalesce(F.trim(x["line_id"]), F.lit("")) == "").alias("without_id"), lack(lambda x: x["quantity"].isNull()).alias("without_quantity"),
        lack(lambda x: x["unit_price"].isNull() | ~x["unit_price"].rlike("[0-9]")).alias("without_price"), F.when(F.coalesce(F.trim("currency"), F.lit("")) == "", "MISSING_CURRENCY").when(F.size(lines) == 0, "NO_LINES").alias("issue"),
    )


# Small words that tell languages apart.
SMALL_WORDS = {"en": r"(?i)\s(the|and|for|with)\s", "de": r"(?i)\s(und|der|die|das)\s", "fr": r"(?i)\s(les|des|est|pour)\s", "es": r"(?i)\s(los|del|para|con)\s", "nl": r"(?i)\s(het|van|een|voor)\s"}


def q_signals(spark: SparkSession, d: str) -> DataFrame:
    """Detectors over whole texts: table, total and tax, currencies named, and the language whose small words are most frequent."""
    n = F.array(*(F.struct(F.regexp_count("text", F.lit(p)).alias("n"), F.lit(-i).alias("rank"), F.lit(k).alias("code")) for i, (k, p) in enumerate(SMALL_WORDS.items())))
    money = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit("(EUR|USD|GBP|GHS|MYR|ZAR|THB)"), F.lit(1)))), "|")
    df = _docs(spark, d).where("text is not null").select("doc_id", (F.regexp_count("text", F.lit(COLUMNS)) >= 2).alias("has_table"), F.col("text").rlike(TOTAL).alias("has_total"), F.col("text").rlike(TAX).alias("has_tax"), money.alias("currencies"), F.array_max(n).alias("top"))
    return df.select("doc_id", "has_table", "has_total", "has_tax", "currencies", F.when(F.col("top.n") > 0, F.col("top.code")).alias("hint"))


def q_zipped(spark: SparkSession, d: str) -> DataFrame:
    """Numbers and dates of inventoried files put together by place; files whose lists differ in length give none."""
    two = table(spark, d, "document_inventory").where("invoice_number_candidates is not null and date_candidates is not null").select("inventory_id", F.split("invoice_number_candidates", "[|]").alias("a"), F.split("date_candidates", "[|]").alias("b")).where("size(a) = size(b)")
    return two.select("inventory_id", F.posexplode(F.arrays_zip("a", "b")).alias("place", "z")).select("inventory_id", (F.col("place") + 1).alias("place"), F.col("z.a").alias("number"), F.col("z.b").alias("date"))


QUERIES = {f.__name__: f for f in (
    q_candidates, q_identities, q_normal_orders, q_signals, q_zipped,
    q_table_rows, q_key_fields, q_item_kinds, q_order_numbers, q_tax_names, q_rates, q_text_sizes, q_text_coverage, q_full_texts, q_evidence_sources, q_evidence_order, q_evidence_union, q_fact_counts, q_value_evidence, q_class_consensus, q_currency_conflicts,
    q_key_differences, q_acquired, q_models, q_po_violations, q_round_trip, q_markdown_rows, q_plain_names, q_currency_context, q_image_sizes, q_file_parts, q_first_files, q_first_lines, q_confidences, q_inventory_totals, q_run_summary,
)}

_B = "b as (select doc_id, i - 1 as block_index, content from (select doc_id, unnest(string_split(text, chr(10))) as content, generate_subscripts(string_split(text, chr(10)), 1) as i from documents) where trim(content) <> '')"
_TRIM = r"regexp_replace({0}, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')"
_q = lambda s: s.replace("'", "''")
_EV = "ev as (select obs_id, doc_id, unnest(evidence_ids) as evidence_id from observed_supplier_identity), ep as (select *, string_split(evidence_id, ':') as p from ev), e as (select obs_id, evidence_id, try_cast(regexp_extract(p[1], '[0-9]+') as bigint) as seen_in, try_cast(regexp_extract(p[2], '[0-9]+') as int) as page, case when lower(trim(p[3])) in ('native', 'ocr', 'vision', 'derived') then lower(trim(p[3])) end as source, p[4] as digest from ep)"
_DEC = """case when dots > 0 and commas > 0 and strpos(reverse(s), ',') < strpos(reverse(s), '.') then replace(replace(s, '.', ''), ',', '.')
    when dots > 0 and commas > 0 then replace(s, ',', '')
    when commas > 0 then replace(left(s, length(s) - strpos(reverse(s), ',')), ',', '') || '.' || right(s, strpos(reverse(s), ',') - 1)
    when dots > 1 then replace(left(s, length(s) - strpos(reverse(s), '.')), '.', '') || '.' || right(s, strpos(reverse(s), '.') - 1) else s end"""
_TAXNAME = r"trim(regexp_replace(regexp_replace(regexp_replace(content, '(?i)^\s*(?:\([ivx0-9]+\)|[0-9]+\.)\s*', ''), '\(\s*[0-9]+(?:[.,][0-9]+)?\s*%\s*\)|[0-9]+(?:[.,][0-9]+)?\s*%', '', 'g'), '(?:GHS|EUR|USD|GBP|ZAR|MYR|[€$£])\s*[0-9., ]+$|[0-9., ]+ *(?:GHS|EUR|USD|GBP|ZAR|MYR|[€$£])$', '', 'g'), ' :-#')"
_L = "list_filter(coalesce(po_lines, []), lambda l: l is not null)"
_PO_SQL = {
    "id_required": "trim(po_id) <> ''", "number_required": "trim(po_number) <> ''", "supplier_required": "trim(supplier_id) <> ''", "currency_three_letters": "regexp_matches(currency, '^[A-Z]{3}$')", "lines_required": f"len({_L}) > 0",
    "no_null_lines": f"len({_L}) = len(coalesce(po_lines, []))", "line_ids_unique": f"len(list_distinct(list_transform({_L}, lambda l: l.line_id))) = len(list_filter({_L}, lambda l: l.line_id is not null))",
    "quantities_positive": f"len(list_filter({_L}, lambda l: coalesce(l.quantity, 0) <= 0)) = 0", "created_before_loaded": "created_at <= loaded_at",
}
_has = lambda c: f"count(*) filter (coalesce(trim({c}), '') <> '')"
_OBS = " union all ".join(f"select supplier_id as key, '{f}' as field, trim({f}) as value, supplier_row_id as id from suppliers where trim({f}) <> '' and supplier_id is not null" for f in ["name", "vat_id", "country", "email", "bank_iban"])

_TEXT = texts.SQL
_LANGS = list(SMALL_WORDS)
SQL = {
    "q_identities": f"with k as ({masters._KEYS('obs_id', 'observed_supplier_identity')}) select obs_id, vat, name, email, iban, nullif(country, '') as country, " + " + ".join(f"case when {c} <> '' then 1 else 0 end" for c in ("vat", "name", "email", "iban")) + " as n_known from k",
    "q_normal_orders": f"select po_row_id, cast(len({_L}) as int) as n_lines, cast(len(list_filter({_L}, lambda l: coalesce(trim(l.line_id), '') = '')) as int) as without_id, cast(len(list_filter({_L}, lambda l: l.quantity is null)) as int) as without_quantity, cast(len(list_filter({_L}, lambda l: l.unit_price is null or not regexp_matches(l.unit_price, '[0-9]'))) as int) as without_price, case when coalesce(trim(currency), '') = '' then 'MISSING_CURRENCY' when len({_L}) = 0 then 'NO_LINES' end as issue from po_master",
    "q_signals": "with n as (select doc_id, text, " + ", ".join(f"len(regexp_extract_all(text, '{p}')) as n_{k}" for k, p in SMALL_WORDS.items()) + f" from documents where text is not null) select doc_id, len(regexp_extract_all(text, '{COLUMNS}')) >= 2 as has_table, regexp_matches(text, '{TOTAL}') as has_total, regexp_matches(text, '{TAX}') as has_tax, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '(EUR|USD|GBP|GHS|MYR|ZAR|THB)'))), '|') as currencies, case "
    + " ".join(f"when n_{k} > 0 and n_{k} >= greatest({', '.join(f'n_{x}' for x in _LANGS)}) then '{k}'" for k in _LANGS) + " end as hint from n",
    "q_zipped": "with z as (select inventory_id, string_split(invoice_number_candidates, '|') as a, string_split(date_candidates, '|') as b from document_inventory where invoice_number_candidates is not null and date_candidates is not null) select inventory_id, cast(generate_subscripts(a, 1) as int) as place, unnest(a) as number, unnest(b) as date from z where len(a) = len(b)",
    "q_table_rows": rf"""with {_B}, h as (select *, min(block_index) filter (len(regexp_extract_all(content, '{COLUMNS}')) >= 2) over (partition by doc_id) as head from b),
        t as (select *, min(block_index) filter (regexp_matches(content, '{TOTAL}') and block_index > head) over (partition by doc_id) as tot from h),
        c as (select doc_id, block_index, list_transform(string_split_regex(trim(content), '{R.CELLS}'), lambda x: trim(x)) as cells from t where block_index > head and (tot is null or block_index < tot)
          and not (regexp_matches(content, '[0-9]+(?:[.,][0-9]+)?\s*%') and regexp_matches(content, '{TAX}')) and not regexp_matches(content, '^\s*[0-9]+\.?\s*$'))
        select doc_id, cast(block_index as int) as block_index, cast(row_number() over (partition by doc_id order by block_index) as int) as line_no, cast(len(cells) as int) as n_cells, cells[1] as first_cell from c where len(cells) >= 3""",
    "q_key_fields": "select doc_id, field, value from (" + " union all ".join(f"select doc_id, '{f}' as field, regexp_extract(text, '{p}', 1) as value from documents where text is not null" for f, p in R.KEY_FIELDS.items()) + ") where value <> ''",
    "q_item_kinds": r"with l as (select unnest(po_lines) as l from po_master) select l.uom as uom, case when regexp_matches(l.description, '(?i)\b(fee|charge|service|setup|transport|catering|consulting|maintenance|support|meal|hire|hours|runs|cleaning|surveys)\b') then 'SERVICE' else 'GOODS' end as item_type, count(*) as n_lines from l where l is not null group by 1, 2",
    "q_order_numbers": r"select po_row_id, regexp_replace(trim(regexp_replace(case when currency = 'EUR' then 'PO: ' when currency = 'USD' then 'Purchase Order #' else '# ' end || po_number, '[\s\pZ]+', ' ', 'g')), '(?i)^(?:po ?[:#-]?|purchase ?order ?[:#-]?|#) *', '') as number from po_master",
    "q_tax_names": rf"with {_B}, n as (select {_TAXNAME} as tax_name from b where regexp_matches(content, '{TAX}') and regexp_matches(content, '[0-9]')) select tax_name, case when regexp_matches(tax_name, '(?i)\b(vat|mwst|iva|tva|btw|levy)\b') then 'VAT' else 'Tax' end as tax_type, count(*) as n_rows from n group by 1, 2",
    "q_rates": "select case when l_returnflag in ('A', 'N') then cast(printf('%.1f', l_tax * 100) as double) else 0.0 end as rate, count(*) as n_lines from lineitem group by 1",
    "q_text_sizes": r"select doc_id, cast(len(regexp_extract_all(text, '\S+')) as int) as n_words, cast(length(regexp_replace(text, '\s', '', 'g')) as int) as n_letters from documents",
    "q_text_coverage": r"with p as (select source, string_split(text, chr(10) || chr(10)) as p from documents where text is not null), n as (select source, len(p) as n, len(list_filter(p, lambda x: length(regexp_replace(x, '\s', '', 'g')) >= 20)) as k from p) select source, count(*) as n_docs, cast(sum(n) as bigint) as n_pages, cast(sum(k) as bigint) as n_native, count(*) filter (k = n) as n_readable, cast(sum(k) as double) / sum(n) as coverage from n group by 1",
    "q_full_texts": f"with {_B} select doc_id, md5(string_agg(content, chr(10) order by block_index)) as digest, cast(count(*) as int) as n_blocks from b group by 1",
    "q_evidence_sources": f"with {_EV} select source, page, count(*) as n_ids, count(*) filter (not (source is not null and coalesce(regexp_matches(digest, '^[0-9a-f]{{12}}$'), false))) as n_broken, count(distinct seen_in) as n_docs from e group by 1, 2",
    "q_evidence_order": f"with {_EV} select obs_id, string_agg(evidence_id, '|' order by page nulls first, source nulls first, evidence_id) as ids, arg_min(page, (coalesce(page, -1), coalesce(source, ''), evidence_id)) as first_page from e group by 1",
    "q_evidence_union": "with i as (select distinct doc_id, trim(e) as e from (select doc_id, unnest(evidence_ids) as e from observed_supplier_identity where doc_id is not null) where trim(e) <> '') select doc_id, count(*) as n_ids, string_agg(e, '|' order by e) as ids from i group by 1",
    "q_fact_counts": "select obs_id, " + " + ".join(f"case when trim({c}) <> '' then 1 else 0 end" for c in ("name", "vat_id", "country", "email", "bank_iban", "address")) + " as n_facts, cast(coalesce(len(list_distinct(evidence_ids)), 0) as int) as n_evidence from observed_supplier_identity",
    "q_value_evidence": f"with o as ({_OBS}), s as (select key, field, value, string_agg(id, ',' order by id) as ids from (select distinct * from o) group by 1, 2, 3) select key, field, count(*) as n_values, string_agg(value || '<' || ids || '>', '|' order by value || '<' || ids || '>') as observations from s group by 1, 2 having count(*) > 1",
    "q_class_consensus": "with g as (select doc_id as key, coalesce(bool_or(coalesce(page_count = 1, false) and document_class is not null), false) as a, list(distinct document_class) filter (document_class <> 'unknown' and page_count = 1) as f, list(distinct document_class) filter (document_class <> 'unknown') as l from document_inventory where doc_id is not null group by 1), s as (select key, coalesce(case when a then f else l end, []) as v from g) select key, case when len(v) = 1 then v[1] else 'unknown' end as value, cast(len(v) as int) as n_values from s",
    "q_currency_conflicts": f"with o as (select distinct {_TRIM.format('supplier_id')} as supplier_id, upper({_TRIM.format('currency')}) as currency from po_master) select supplier_id, count(*) as n_currencies, string_agg(currency, '|' order by currency) as currencies from o where supplier_id <> '' and currency <> '' group by 1 having count(*) > 1",
    "q_key_differences": """with p as (select po_id, po_row_id, list_sort(list_distinct(list_transform(list_filter(coalesce(po_lines, []), lambda l: l is not null), lambda l: l.line_id))) as ids from po_master where po_id is not null),
        g as (select po_id, arg_min(ids, po_row_id) as a, arg_max(ids, po_row_id) as b, count(*) as n from p group by 1) select po_id, array_to_string(list_filter(a, lambda x: not list_contains(b, x)), '|') as missing, array_to_string(list_filter(b, lambda x: not list_contains(a, x)), '|') as unexpected from g where n > 1""",
    "q_acquired": "with c as (select doc_id, max(total_characters) as n_chars from document_inventory where doc_id is not null group by 1) select d.doc_id, case when c.doc_id is null then 'read' else 'cache' end as origin, c.n_chars from documents d left join c on c.doc_id = d.doc_id",
    "q_models": f"with d as (select lower(substring(coalesce({_TRIM.format('lang')}, ''), 1, 2)) as code from documents) select case " + " ".join(f"when code = '{k}' then '{v}'" for k, v in MODELS.items()) + " else 'default' end as model, count(*) as n_docs from d group by 1",
    "q_po_violations": "select rule, currency, count(*) as n_orders from (" + " union all ".join(f"select '{n}' as rule, currency from po_master where not coalesce({c}, false)" for n, c in _PO_SQL.items()) + ") group by 1, 2",
    "q_round_trip": "select currency, count(*) as n_orders, cast(0 as bigint) as n_changed from po_master group by 1",
    "q_markdown_rows": rf"""with {_B}, c as (select doc_id, block_index, list_transform(string_split(trim(content, '| '), '|'), lambda x: trim(x)) as c from b where contains(content, '|')),
        k as (select doc_id, block_index, c[1] as description, case when regexp_matches(c[2], '^[0-9]+(?:[.,][0-9]+)?$') then c[2] end as quantity, regexp_extract(c[-1], '([0-9]+(?:[.,][0-9]{{3}})*[.,][0-9]{{2}})', 1) as s from c where len(c) >= 3 and not regexp_matches(c[1], '{COLUMNS}') and not regexp_matches(c[2], '{COLUMNS}')),
        m as (select *, length(s) - length(replace(s, '.', '')) as dots, length(s) - length(replace(s, ',', '')) as commas from k)
        select doc_id, cast(block_index as int) as block_index, description, quantity, cast(try_cast({_DEC} as decimal(38,6)) as double) as amount from m""",
    "q_plain_names": "select lower(strip_accents(name)) as plain, count(distinct name) as n_spellings, count(*) as n_rows from suppliers where name is not null group by 1",
    "q_currency_context": r"""with s as (select inventory_id, regexp_extract(currency_candidates, '([A-Z]{3}|[$€£])', 1) as sign, concat_ws(' ', currency_candidates, language_hints) as x from document_inventory where currency_candidates is not null)
        select inventory_id, sign, case when regexp_matches(sign, '^[A-Z]{3}$') then case when sign = 'GHC' then 'GHC' else sign end when sign = '$' and regexp_matches(x, '(?i)\b(usd|us\$|united states)\b') then 'USD' when sign = '$' and regexp_matches(x, '(?i)(ghana|\bghs\b)') then 'GHS'
          when sign = '€' and regexp_matches(x, '(?i)\b(eur|germany|deutschland|france|portugal|nederland|eesti)\b') then 'EUR' when sign = '£' and regexp_matches(x, '(?i)\b(gbp|united kingdom|\buk)\b') then 'GBP' else sign end as currency from s where sign <> ''""",
    "q_image_sizes": "select p_partkey, case when p_size < 40 then cast(p_size as int) end as width, case when p_size < 40 then cast(p_partkey as int) end as height from part",
    "q_file_parts": r"with s as (select inventory_id, regexp_replace(filename, '\.[^.]*$', '') as stem from document_inventory where filename is not null) select inventory_id, upper(regexp_extract(stem, '^([A-Za-z]+)', 1)) as kind, try_cast(regexp_extract(stem, '([0-9]+)$', 1) as bigint) as number, cast(length(stem) as int) as n_stem from s",
    "q_first_files": "select distinct filename from document_inventory where filename is not null order by lower(filename), filename limit 10",
    "q_first_lines": "with h as (select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[1:3], ' / ') as head from documents where text is not null) select doc_id, head, regexp_extract(head, '([0-9]+)', 1) as number from h",
    "q_confidences": f"with {_B}, c as (select source, round(1 - 1.0 / (length(content) + 1), 3) as c from b join documents using (doc_id)) select source, cast(round(avg(c), 6) as double) as mean, cast(min(c) as double) as least, cast(max(c) as double) as greatest, round(avg(case when c < 0.9 then 1.0 else 0.0 end), 6) as low_share from c group by 1",
    "q_inventory_totals": f"select count(*) as n_rows, count(distinct doc_id) as n_docs, count(distinct filename) as n_files, cast(sum(page_count) as bigint) as n_pages, count(*) filter (is_multi_page) as n_multi_page, count(*) filter (not is_multi_page) as n_single_page, max(page_count) as most_pages, cast(sum(file_size_bytes) as bigint) as n_bytes, cast(sum(total_words) as bigint) as n_words, cast(sum(total_characters) as bigint) as n_chars, count(*) filter (total_characters < 20) as n_without_text, {_has('currency_candidates')} as with_currency, {_has('invoice_number_candidates')} as with_number, {_has('date_candidates')} as with_date, {_has('po_number_candidates')} as with_order, count(*) filter (payable_status = 'likely_payable') as n_payable, count(distinct document_class) as n_classes from document_inventory",
    "q_run_summary": "select master_name, case when payload is null or trim(payload) = '' then 'empty' when json_valid(payload) then 'read' else 'failed' end as status, count(*) as n_deliveries, cast(sum(length(payload)) as bigint) as n_chars from master_feed group by 1, 2",
}
SQL["q_candidates"] = f"select doc_id, 'key' as kind, field, value from ({SQL['q_key_fields']}) union all select doc_id, 'label', field, value from ({_TEXT['q_fields']}) union all select doc_id, 'line', 'description', description from ({_TEXT['q_table_lines']})"
