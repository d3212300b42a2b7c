"""Pages of documents: role and relevance, grouping into logical documents, and assembly of groups into financial documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import ship

#: Kinds of words that the rules below ask for.
KINDS = ("title", "meta", "credit", "debit", "order", "supporting", "receipt", "remittance", "payable", "tax", "line")


def pages(docs: DataFrame) -> DataFrame:
    """(doc_id, page_no, lines array) of docs (doc_id, text): paragraphs stand for pages, numbered from 1; no shuffle. Null texts give no row."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n\n")).alias("k", "page")).select("doc_id", (F.col("k") + 1).alias("page_no"), F.split("page", "\n").alias("lines"))


def lines_with(pattern: str, lines: str = "lines") -> Column:
    """How many lines a pattern occurs in."""
    return F.size(F.filter(lines, lambda x: x.rlike(pattern)))


def classified(pages: DataFrame, words: dict[str, str], page: str, keyword: str) -> DataFrame:
    """pages (doc_id, page_no, lines) with a count of lines per kind of words (see KINDS), `current`, `total`, `continues`, `role` and `relevance`.

    page: pattern with two groups, a page's number and how many there are; the last line that has it counts. A page continues another if some such number is
    above 1, or by a keyword. Roles are asked in a fixed order; a page has signs of an invoice by title, by its particulars, or by a tax beside lines. What is
    payable follows from role and counts. Everything is read off each page's own row.
    """
    # read off once: behind a generator, Catalyst does not repeat the counts in every rule that asks for them
    counts = F.struct(*(lines_with(words[k]).alias(k) for k in KINDS), F.filter("lines", lambda x: x.rlike(page)).alias("_marked"), lines_with(keyword).alias("_keyword"))
    number = lambda x, k: F.regexp_extract(x, page, k).try_cast("int")
    last = F.try_element_at("_marked", F.lit(-1))
    df = pages.select("*", F.inline(F.array(counts))).withColumns({
        "current": number(last, 1), "total": number(last, 2), "continues": F.exists("_marked", lambda x: F.coalesce(number(x, 1) > 1, F.lit(False))) | (F.col("_keyword") > 0),
    }).drop("_marked", "_keyword")
    has = lambda k: F.col(k) > 0
    invoice = has("title") | has("meta") | (has("tax") & has("line"))
    role = (
        F.when(has("credit"), "credit_memo").when(has("debit"), "debit_memo").when(has("order") & ~invoice, "purchase_order").when(has("receipt") & ~invoice, "receipt").when(has("remittance") & ~invoice, "remittance")
        .when(F.col("continues") & ~(has("title") & has("meta")), "continuation").when(has("supporting") & ~invoice, "supporting_document").when(invoice, "invoice").when(has("supporting"), "supporting_document").otherwise("unknown")
    )
    df = df.withColumn("role", role)
    relevance = (
        F.when(F.col("role").isin("purchase_order", "receipt", "remittance"), "non_payable").when(has("payable"), "payable_candidate")
        .when(F.col("role").isin("invoice", "credit_memo", "debit_memo") & has("tax") & has("line"), "payable_candidate").when(F.col("role").isin("supporting_document", "continuation"), "supporting").otherwise("ambiguous")
    )
    return df.withColumn("relevance", relevance)


def numbers_of(lines: Column | str, pattern: str, stop: list[str]) -> Column:
    """Distinct document numbers of a page: matches of at least three letters that hold a digit and are no stop word, sorted."""
    found = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(f"({pattern})"), F.lit(1))))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: (F.length(x) >= 3) & x.rlike("[0-9]") & ~F.upper(x).isin(stop))))


GROUPED = "doc_id long, page_no int, group_no int, score int, by_number boolean, by_continuation boolean"


def grouped(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, group_no, score, by_number, by_continuation) of pages (doc_id, pages array<struct<page_no, numbers, current, total, continues>>).

    A page joins the newest open group that accepts it. None does whose numbers are all other ones, that already has a page 1 when this one says 1, or that has all
    the pages it declares. A shared number scores 10, the next page of the same total 15, a continuation 8; 8 suffice. A group takes over the page's numbers,
    total and place. A page that none accepts opens a group (score 0). One document is one row and one scan; nothing is shuffled.
    """
    ship(pages.sparkSession)

    def fold(own: list[dict]) -> Iterator[tuple]:
        groups: list[dict] = []
        for p in own:
            numbers, now, of = set(p["numbers"] or ()), p["current"], p["total"]
            for g in reversed(groups):
                shared = bool(numbers & g["numbers"])
                if (numbers and g["numbers"] and not shared) or (now == 1 and 1 in (g["last"], g["anchor"])) or (g["total"] is not None and g["n"] >= g["total"]):
                    continue
                follows = now is not None and of is not None and of == g["total"] and g["last"] is not None and now == g["last"] + 1
                score = 10 * shared + 15 * follows + 8 * bool(p["continues"])
                if score >= 8:
                    break
            else:
                g, score, shared = {"id": len(groups) + 1, "numbers": set(), "last": None, "anchor": now, "total": None, "n": 0}, 0, False
                groups.append(g)
            g["numbers"] |= numbers
            g["n"] += 1
            g["total"], g["last"] = of if of is not None else g["total"], now if now is not None else g["last"]
            yield p["page_no"], g["id"], score, shared, bool(score and p["continues"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_())
        for b in batches:
            rows = [(d, *r) for d, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in fold(own or [])]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in GROUPED.split(", ")])

    return pages.selectExpr("cast(doc_id as long) as doc_id", "pages").mapInArrow(run, GROUPED)


ASSEMBLED = "doc_id long, group_no int, assembly_no int, relationship string"


def assembled(groups: DataFrame) -> DataFrame:
    """(doc_id, group_no, assembly_no, relationship) of groups (doc_id, groups array<struct<group_no, first_page, last_page, role, relevance, number, currency, totals, shared, links>>).

    Groups go by their first page. One is supporting (to the newest assembly, or alone if there is none) by role or relevance, or because its currency is another one
    than the newest assembly's, or it shares numbers and begins behind it; not if it is payable under another number. Others continue the newest assembly that
    they fit: no other number or currency, and a continuation by role, or the next page with links to it, or of unclear relevance with the same number or with
    neither number nor totals. The rest begin assemblies. An assembly takes over what it lacked and the pages it gains.
    """
    ship(groups.sparkSession)
    key = lambda x: x.strip().upper() if x else None
    other = lambda a, b: a is not None and b is not None and a != b

    def fold(own: list[dict]) -> Iterator[tuple]:
        open_: list[dict] = []
        for g in sorted(own, key=lambda g: (g["first_page"] if g["first_page"] is not None else 9999, g["group_no"])):
            number, currency = key(g["number"]), key(g["currency"])

            def supports(a: dict | None, g: dict = g, number: str | None = number, currency: str | None = currency) -> bool:
                if g["relevance"] == "supporting" or g["role"] == "supporting_document":
                    return True
                if a is None or (g["relevance"] == "payable_candidate" and other(number, a["number"])):
                    return False
                return other(currency, a["currency"]) or bool(g["shared"] and g["first_page"] > a["last"])

            def continues(a: dict, g: dict = g, number: str | None = number, currency: str | None = currency) -> bool:
                if a["relevance"] == "supporting" or supports(a) or other(number, a["number"]) or other(currency, a["currency"]):
                    return False
                if g["role"] == "continuation":
                    return True
                unclear = g["relevance"] == "ambiguous"
                same = number is not None and number == a["number"]
                return g["first_page"] == a["last"] + 1 and bool(g["links"] or (same and unclear) or (unclear and number is None and not g["totals"]))

            if supports(open_[-1] if open_ else None):
                if open_:
                    yield g["group_no"], open_[-1]["no"], "supporting_isolated"
                    continue
                kind = "standalone_supporting"
            else:
                into = next((a for a in reversed(open_) if continues(a)), None)
                if into is not None:
                    into["number"], into["currency"], into["last"] = into["number"] or number, into["currency"] or currency, max(into["last"], g["last_page"])
                    yield g["group_no"], into["no"], "continuation"
                    continue
                kind = "primary_anchor"
            open_.append({"no": len(open_) + 1, "number": number, "currency": currency, "last": g["last_page"], "relevance": g["relevance"]})
            yield g["group_no"], len(open_), kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, *r) for d, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in fold(own or [])]
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=[x.split()[0] for x in ASSEMBLED.split(", ")])

    return groups.selectExpr("cast(doc_id as long) as doc_id", "groups").mapInArrow(run, ASSEMBLED)


def merged(facts: DataFrame, by: list[str], order: str, fields: list[str]) -> DataFrame:
    """(by..., field, value, n_conflicts, conflicts) of facts (by..., order, fields...): the first value of each field in order, and the later ones that differ from it.

    The first one wins and is never overwritten; conflicts are the other values with their place, in order, joined by '|'. Values are compared in upper case without
    blanks around them. Fields without a value give no row. One shuffle, by the key.
    """
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value")) for f in fields))
    long = facts.select(*by, F.col(order).alias("_at"), F.inline(F.filter(rows, lambda r: r["value"] != "")))
    seen = long.groupBy(*by, "field").agg(F.array_sort(F.collect_list(F.struct("_at", "value"))).alias("_seen"))
    first = F.element_at("_seen", 1)["value"]
    differ = F.filter("_seen", lambda s: F.upper(s["value"]) != F.upper(first))
    return seen.select(*by, "field", first.alias("value"), F.size(differ).alias("n_conflicts"), F.array_join(F.transform(differ, lambda s: F.concat_ws(":", s["_at"].cast("string"), s["value"])), "|").alias("conflicts"))


def appended(first: DataFrame, later: DataFrame, signature: list[str]) -> DataFrame:
    """first and those rows of later whose signature first does not have: a row seen twice counts once, equal rows with signatures of their own or none all stay."""
    known = first.select(*signature).where(" or ".join(f"{s} is not null" for s in signature)).distinct()
    match = [F.col(f"l.{s}").eqNullSafe(F.col(f"k.{s}")) for s in signature]
    cond = match[0]
    for m in match[1:]:
        cond = cond & m
    return first.unionByName(later.alias("l").join(known.alias("k"), cond, "left_anti"))
