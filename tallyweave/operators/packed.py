"""Fields that hold several values: a quote-aware finite-state tokenizer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyweave.session import ship

# Quotes and brackets that may enclose a value or a list of values.
QUOTES = {'"': '"', "'": "'", "`": "`", "«": "»", "“": "”", "„": "“", "‘": "’"}
BRACKETS = {"[": "]", "{": "}", "(": ")"}
HARD = frozenset("|;\n\r\t\v\f\x1e\x1f")


@dataclass(frozen=True)
class Notation:
    """How a field separates values, apart from | ; tab and line end, which always do.

    tight: characters that separate anywhere outside quotes. spaced: characters that separate only between white space.
    atom: pattern of a whole value; a single space separates two values if it stands between two of them.
    comma_joins: a comma stays inside the value if the text before it matches the first and the text after it the second pattern.
    """

    tight: frozenset[str] = frozenset(",")
    spaced: frozenset[str] = frozenset("/+&")
    atom: re.Pattern[str] | None = None
    comma_joins: tuple[re.Pattern[str], re.Pattern[str]] | None = None


_DATE = r"(?:\d{1,4}[./-]\d{1,2}[./-]\d{1,4}|\d{1,2}\.?\s[^\W\d_]+\.?\s\d{4}|[^\W\d_]+\.?\s\d{1,2},?\s\d{4})"
_CODE = r"(?:[A-Z]{3}|[A-Z]{0,3}[$€£¥₵฿₦₹]|RM|R)"
NOTATIONS = {
    "currency": Notation(tight=frozenset(",/+"), atom=re.compile(_CODE)),
    "number": Notation(),
    "date": Notation(atom=re.compile(_DATE), comma_joins=(re.compile(r"^[^\W\d_]+\.?\s+\d{1,2}$"), re.compile(r"\s*\d{4}(?!\d)"))),
}

START, BARE, QUOTED, AFTER = range(4)


def tokens(text: str, notation: Notation) -> list[str]:
    """Non-blank values of a packed text, in order.

    States: START (before a value), BARE (in an unquoted one), QUOTED, AFTER (behind a closing quote). A quote opens only at
    the start of a value; inside, a doubled closing quote and a backslash before a quote or backslash stand for the character;
    a quote that never closes is an ordinary character. Brackets that open at the start of a value raise the nesting depth and
    are dropped with their partners. Delimiters count only outside quotes.
    """
    out: list[str] = []
    value: list[str] = []
    stack: list[str] = []
    state, close, i, n = START, "", 0, len(text)
    quoted_from = 0
    dead: set[str] = set()  # closers that do not come any more

    def closes(mark: str) -> bool:
        if mark in dead or text.find(mark, i + 1) < 0:
            dead.add(mark)
            return False
        return True

    def emit() -> None:
        item = "".join(value).strip()
        if item:
            out.append(item)
        value.clear()

    while i < n:
        c = text[i]
        if state == QUOTED:
            if c == "\\" and i + 1 < n and text[i + 1] in (close, "\\"):
                value.append(text[i + 1])
                i += 2
            elif c == close:
                if i + 1 < n and text[i + 1] == close:
                    value.append(c)
                    i += 2
                else:
                    state = AFTER
                    i += 1
            else:
                value.append(c)
                i += 1
            if i >= n and state == QUOTED:  # never closed: read it again as bare text
                value[:] = [text[quoted_from]]
                state, i = BARE, quoted_from + 1
            continue
        if state == START:
            if c in QUOTES and closes(QUOTES[c]):
                state, close, quoted_from = QUOTED, QUOTES[c], i
                i += 1
                continue
            if c in BRACKETS and closes(BRACKETS[c]):
                stack.append(BRACKETS[c])
                i += 1
                continue
        if stack and c == stack[-1]:
            stack.pop()
            emit()
            state = START
            i += 1
            continue
        if c in HARD or c in notation.tight:
            if c == "," and state == BARE and notation.comma_joins and notation.comma_joins[0].match("".join(value).strip()) and notation.comma_joins[1].match(text, i + 1):
                value.append(c)
            else:
                emit()
                state = START
            i += 1
            continue
        if c in notation.spaced and (i == 0 or text[i - 1].isspace() or state != BARE) and (i + 1 == n or text[i + 1].isspace()):
            emit()
            state = START
            i += 1
            continue
        if c.isspace():
            j = i + 1
            while j < n and text[j].isspace() and text[j] not in HARD:
                j += 1
            if state == START:
                pass
            elif j < n and text[j] not in HARD and text[j] not in notation.tight:
                if state == AFTER:
                    split = text[j] in QUOTES or notation.atom is not None
                else:
                    split = j - i > 1
                    if notation.atom is not None and not split and notation.atom.fullmatch("".join(value).strip()):
                        ahead = notation.atom.match(text, j)
                        split = text[j] in QUOTES or bool(ahead and (ahead.end() == n or not text[ahead.end()].isalnum()))
                if split:
                    emit()
                    state = START
                else:
                    value.append(text[i:j])
            i = j
            continue
        value.append(c)
        state = BARE
        i += 1
    emit()
    return out


def split_packed(df: DataFrame, row_id: str, fields: dict[str, str]) -> DataFrame:
    """One row per value of the packed string columns `fields` (column name -> notation name): (row_id, field_name, item_pos, item_value).

    item_pos counts the non-blank values of a field from 1. Null, empty and blank fields give no row; so does an empty table.
    A row id that repeats gives the rows of each of its rows. Only the named columns are read; others, of whatever name, are
    left out. No shuffle: each batch of rows is tokenized where it is read, whole fields at a time.
    """
    ship(df.sparkSession)
    schema = T.StructType([T.StructField(row_id, df.schema[row_id].dataType), T.StructField("field_name", T.StringType()), T.StructField("item_pos", T.LongType()), T.StructField("item_value", T.StringType())])
    names = list(fields)
    arrow_id = pa.int64() if isinstance(df.schema[row_id].dataType, T.LongType) else None
    notations = {name: NOTATIONS[kind] for name, kind in fields.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            key, field, pos, item = [], [], [], []
            for k, name in enumerate(names, 1):
                notation = notations[name]
                for row, text in zip(ids, batch.column(k).to_pylist()):
                    if text:
                        for at, value in enumerate(tokens(text, notation), 1):
                            key.append(row)
                            field.append(name)
                            pos.append(at)
                            item.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(key, arrow_id or batch.column(0).type), pa.array(field, pa.string()), pa.array(pos, pa.int64()), pa.array(item, pa.string())], names=[row_id, "field_name", "item_pos", "item_value"])

    return df.select(row_id, *names).mapInArrow(run, schema)
