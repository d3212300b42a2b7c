"""Scalar functions on text columns; built-in expressions unless said otherwise. Null gives null."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.session import ship

# Marks that may stand around a name, and separators inside identifiers.
PERIPHERAL = " '.,;:()[]{}\""
SEPARATORS = r"[\s\-.]+"


@F.pandas_udf(T.StringType())
def _compatible(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(T.StringType())
def _unaccented(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


def _with_package() -> None:
    """Arrow functions of this module need the package on the executors."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)


def squeezed(col: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(col, r"[\s\p{Z}]+", " "))


def text_key(col: Column) -> Column:
    """Compatibility-composed, case-folded, squeezed text. Spark has no expression for the first two, so an Arrow function does them."""
    _with_package()
    return squeezed(_compatible(col))


def name_key(col: Column) -> Column:
    """text_key without marks around it."""
    return F.btrim(text_key(col), F.lit(PERIPHERAL))


def code_key(col: Column) -> Column:
    """Trimmed; case is kept."""
    return F.regexp_replace(col, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def identifier_key(col: Column) -> Column:
    """Upper case without white space, hyphens and dots."""
    return F.regexp_replace(F.upper(col), SEPARATORS, "")


def account_key(col: Column) -> Column:
    """Upper case without white space and hyphens; dots stay."""
    return F.regexp_replace(F.upper(col), r"[\s\-]+", "")


def unaccented(col: Column) -> Column:
    """Text without combining marks (an Arrow function)."""
    _with_package()
    return _unaccented(col)


def currency_key(col: Column) -> Column:
    return F.upper(code_key(col))


def rate(col: Column) -> Column:
    """A percentage such as '19 %' as decimal, null if it is none."""
    return F.trim(F.replace(col, F.lit("%"), F.lit(""))).try_cast("decimal(18,6)")


def to_decimal(col: Column) -> Column:
    """A number in any separator style as decimal(38,6).

    Currency signs and % go. With one kind of separator, several dots or commas group thousands except the last comma; a lone comma or dot is the
    decimal point. With both kinds the rightmost is the decimal point. Blank and other text gives null.
    """
    s = F.trim(F.regexp_replace(col, "[$€£%]", ""))
    dots, commas = F.length(s) - F.length(F.replace(s, F.lit("."), F.lit(""))), F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
    last = lambda mark: F.length(s) - F.instr(F.reverse(s), mark)
    join = lambda x, mark: F.regexp_replace(x, rf"[{mark}](?=.*[{mark}])", "")
    plain = (
        F.when((dots > 0) & (commas > 0) & (last(",") > last(".")), F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when((dots > 0) & (commas > 0), F.replace(s, F.lit(","), F.lit("")))
        .when(commas > 0, F.replace(join(s, ","), F.lit(","), F.lit(".")))
        .when(dots > 1, join(s, "."))
        .otherwise(s)
    )
    return plain.try_cast("decimal(38,6)")


def iso_date(col: Column) -> Column:
    """'yyyy-mm-dd' of a numeric date: year first, or day first where the first number is above 12, or month first where the second is; else null.

    Day numbers up to 31 are taken for every month.
    """
    y, a, b = (F.regexp_extract(col, r"^\s*(\d{4})[-./](\d{1,2})[-./](\d{1,2})\s*$", k) for k in (1, 2, 3))
    c, d, z = (F.regexp_extract(col, r"^\s*(\d{1,2})[-./](\d{1,2})[-./](\d{4})\s*$", k) for k in (1, 2, 3))
    n = lambda x: x.try_cast("int")
    two = lambda x: F.lpad(x, 2, "0")
    day, month = lambda x: n(x).between(1, 31), lambda x: n(x).between(1, 12)
    return (
        F.when(month(a) & day(b), F.concat_ws("-", y, two(a), two(b)))
        .when((n(c) > 12) & day(c) & month(d), F.concat_ws("-", z, two(d), two(c)))
        .when((n(d) > 12) & day(d) & month(c), F.concat_ws("-", z, two(c), two(d)))
    )


AMOUNT = r"\d{1,3}(?:[.,\s]\d{3})+[.,]\d{2}|\d+[.,]\d{2}"


def amounts(col: Column) -> Column:
    """All amounts with two decimals in a text, in order."""
    return F.regexp_extract_all(col, F.lit(f"({AMOUNT})"), F.lit(1))


def evidence_id(doc: Column, index: Column, source: Column, content: Column) -> Column:
    """An id from where a piece of text was seen and what it says: document:source:first 12 hex digits of the SHA-256 of all parts."""
    return F.concat_ws(":", doc.cast("string"), source, F.substring(F.sha2(F.concat_ws("|", doc.cast("string"), source, content, index.cast("string")), 256), 1, 12))


def distinct_texts(col: Column) -> Column:
    """Trimmed, non-blank, distinct texts of an array, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(col, lambda x: F.trim(x)), lambda x: x != "")))


def png_size(col: Column) -> Column:
    """(width, height) from the header of a PNG image, null for other bytes."""
    part = lambda at: F.conv(F.hex(F.substring(col, at, 4)), 16, 10).try_cast("int")
    return F.when(F.hex(F.substring(col, 1, 8)) == "89504E470D0A1A0A", F.struct(part(17).alias("width"), part(21).alias("height")))


def rate_value(col: Column) -> Column:
    """A rate as a double of four decimals (half to even), 0 where it cannot be read."""
    return F.coalesce(F.bround(F.trim(F.replace(col, F.lit("%"), F.lit(""))).try_cast("double"), 4), F.lit(0.0))


# Sources that evidence may come from.
SOURCES = ("native", "ocr", "vision", "derived")


def source_key(col: Column) -> Column:
    """A source's name in lower case without blanks around it, null if it is none of SOURCES."""
    s = F.lower(code_key(col))
    return F.when(s.isin(*SOURCES), s)


def without_order_prefix(col: Column) -> Column:
    """An order number without a leading 'PO', 'purchase order' or '#'."""
    return F.regexp_replace(squeezed(col), r"(?i)^(?:po ?[:#-]?|purchase ?order ?[:#-]?|#) *", "")


def tax_name(col: Column) -> Column:
    """The name in a tax row: without a leading number, percentages, numbers in brackets, an amount at the end and marks around it."""
    s = F.regexp_replace(col, r"(?i)^\s*(?:\([ivx0-9]+\)|[0-9]+\.)\s*", "")
    s = F.regexp_replace(s, r"\(\s*[0-9]+(?:[.,][0-9]+)?\s*%\s*\)|[0-9]+(?:[.,][0-9]+)?\s*%", "")
    s = F.regexp_replace(s, r"(?:GHS|EUR|USD|GBP|ZAR|MYR|[€$£])\s*[0-9., ]+$|[0-9., ]+ *(?:GHS|EUR|USD|GBP|ZAR|MYR|[€$£])$", "")
    return F.btrim(s, F.lit(" :-#"))


def tax_kind(name: Column) -> Column:
    return F.when(name.rlike(r"(?i)\b(vat|mwst|iva|tva|btw|levy)\b"), "VAT").otherwise("Tax")


def item_kind(col: Column) -> Column:
    """SERVICE by the words of a description, else GOODS."""
    return F.when(col.rlike(r"(?i)\b(fee|charge|service|setup|transport|catering|consulting|maintenance|support|meal|hire|hours|runs|cleaning|surveys)\b"), "SERVICE").otherwise("GOODS")


def n_words(col: Column) -> Column:
    return F.regexp_count(col, F.lit(r"\S+"))


def n_letters(col: Column) -> Column:
    """Characters that are no white space."""
    return F.length(F.regexp_replace(col, r"\s", ""))


def currency_in_context(code: Column, context: Column) -> Column:
    """An ISO code as it is; a sign by what else the text says: '$' is USD or GHS, '€' EUR and '£' GBP where the context names their land, else the sign."""
    said = lambda p: context.rlike(p)
    c = currency_key(code)
    return (
        F.when(c.rlike("^[A-Z]{3}$"), c).when(c.isin("GH¢", "GH₵", "GHC"), "GHS").when((c == "$") & said(r"(?i)\b(usd|us\$|united states)\b"), "USD").when((c == "$") & said(r"(?i)(ghana|\bghs\b)"), "GHS")
        .when((c == "€") & said(r"(?i)\b(eur|germany|deutschland|france|portugal|nederland|eesti)\b"), "EUR").when((c == "£") & said(r"(?i)\b(gbp|united kingdom|\buk)\b"), "GBP").otherwise(c)
    )
