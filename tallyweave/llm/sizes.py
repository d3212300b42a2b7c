"""Sizes of texts in tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters, digits and underscores or a run of other characters that are not white space.
TOKEN = re.compile(r"\w+|[^\w\s]+")
TOKEN_JVM = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]+"


def n_tokens(text: Column) -> Column:
    """Number of tokens of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN_JVM)), F.lit(0)).cast("long")
