"""Fields and table rows read from blocks of text (doc_id, block_index, content); built-in expressions only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.text import to_decimal

CELLS = r"\s*[|;\t]\s*|\s{2,}"
NUMBER = r"^[0-9][0-9.,]*$"


def table_lines(blocks: DataFrame) -> DataFrame:
    """(doc_id, block_index, description, quantity, unit_price, amount, currency): blocks that are rows of four cells with numbers in the last three.

    Cells are parted by bars, semicolons, tabs or wide gaps; a currency stands on either side of the amount or nowhere. Heads, totals and prose
    have other cells and give no row; numbers are read in any separator style, null where they cannot be.
    """
    c = blocks.withColumn("c", F.split(F.trim("content"), CELLS)).where("size(c) = 4").select("doc_id", "block_index", *(F.trim(F.col("c")[i]).alias(n) for i, n in enumerate(("description", "q", "p", "a"))))
    money = F.trim(F.regexp_replace("a", "[A-Z]{3}", ""))
    rows = c.withColumn("money", money).where(F.col("q").rlike(NUMBER) & F.col("p").rlike(NUMBER) & F.col("money").rlike(NUMBER) & ~F.col("description").rlike(NUMBER))
    value = lambda x: to_decimal(F.col(x)).cast("double")
    return rows.select("doc_id", "block_index", "description", value("q").alias("quantity"), value("p").alias("unit_price"), value("money").alias("amount"), F.regexp_extract("a", "([A-Z]{3})", 1).alias("currency"))


def labelled(blocks: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(doc_id, block_index, field, value): blocks 'label: value' whose label matches a field's pattern; the first field in order wins."""
    at = F.instr("content", ":")
    field = F.coalesce(*(F.when(F.substring("content", F.lit(1), at - 1).rlike(p), n) for n, p in labels.items()))
    value = F.trim(F.substring("content", at + 1, F.length("content")))
    return blocks.where(at > 1).select("doc_id", "block_index", field.alias("field"), value.alias("value")).where("field is not null and value <> ''")


def money(col: Column) -> tuple[Column, Column]:
    """(currency code or '', amount) of a text such as 'EUR 1.234,50' or '1 234,50 EUR'; spaces group thousands."""
    text = F.regexp_replace(F.regexp_replace(col, "[A-Z]{3}", ""), r"\s", "")
    return F.regexp_extract(col, "([A-Z]{3})", 1), to_decimal(text)


def contexts(values: DataFrame, key: str, code: str, hints: DataFrame, hint: str) -> DataFrame:
    """values with `code` replaced, where it is ambiguous ('$' and the like), by the one code that the same key's hints name; kept if they name none or several."""
    one = hints.where(F.col(hint).isNotNull()).groupBy(key).agg(F.when(F.countDistinct(hint) == 1, F.min(hint)).alias("_one"))
    return values.join(one, key, "left").withColumn(code, F.when(F.length(code) != 3, F.coalesce("_one", F.col(code))).otherwise(F.col(code))).drop("_one")


def table_rows(blocks: DataFrame, columns: str, total: str, tax: str) -> DataFrame:
    """(doc_id, block_index, line_no, cells): the rows of each text's table: what stands below the first head and above the first total behind it.

    A head has at least two words of `columns` (a pattern); rows with fewer than three cells, with a percentage beside a word of `tax`, or that are a number alone
    are no lines. Lines are numbered from 1. A text's blocks are one array, so nothing is shuffled but by doc_id.
    """
    own = Window.partitionBy("doc_id")
    at = lambda c: F.min(F.when(c, F.col("block_index"))).over(own)
    df = blocks.withColumn("_head", at(F.regexp_count("content", F.lit(columns)) >= 2))
    df = df.withColumn("_total", at(F.col("content").rlike(total) & (F.col("block_index") > F.col("_head"))))
    df = df.where("block_index > _head and (_total is null or block_index < _total)").withColumn("cells", F.transform(F.split(F.trim("content"), CELLS), lambda x: F.trim(x)))
    rate = F.col("content").rlike(r"[0-9]+(?:[.,][0-9]+)?\s*%") & F.col("content").rlike(tax)
    lines = df.where((F.size("cells") >= 3) & ~rate & ~F.col("content").rlike(r"^\s*[0-9]+\.?\s*$"))
    return lines.select("doc_id", "block_index", F.row_number().over(own.orderBy("block_index")).alias("line_no"), "cells")


#: Fields and the patterns that find them, the value being the first group.
KEY_FIELDS = {
    "vat_id": r"\b((?:DE|GB|FR|PT|NL|EE|ES)[ -]?[0-9]{8,11}(?:B[0-9]{2})?)\b", "iban": r"\b([A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){3,7}(?: ?[0-9]{1,3})?)\b", "email": r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})",
    "po_number": r"(?i)(?:purchase order|bestellung|\bpo)[ :#-]+([A-Z0-9/-]*[0-9][A-Z0-9/-]*)", "invoice_number": r"(?i)(?:invoice|document|beleg|rechnungs) ?(?:number|nummer|no\.?)[ :]+([A-Z0-9/-]*[0-9][A-Z0-9/-]*)",
    "iso_date": r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b",
}


def key_fields(docs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(doc_id, field, value) of docs (doc_id, text): the first value of every field in the whole text; fields that it lacks give no row. No shuffle."""
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.regexp_extract("text", p, 1).alias("value")) for f, p in patterns.items()))
    return docs.where("text is not null").select("doc_id", F.inline(F.filter(rows, lambda r: r["value"] != "")))
