"""Text functions: the search tokenizer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Letters, marks, numbers and the underscore; the ranges written out are those the regex engine looks up in a bit set.
WORD = "[a-z0-9_\u00e0-\u00f6\u00f8-\u00ff\u00df\\p{L}\\p{M}\\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased Unicode words; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def parameter_bucket(value: Column, absent: str) -> Column:
    """A bounded label of an integer parameter."""
    out = F.when(value.isNull(), absent).when(value <= 0, "nonpositive").when(value == 1, "1").when(value == 2, "2")
    for low, high in ((3, 4), (5, 8), (9, 16), (17, 32), (33, 64)):
        out = out.when(value.between(low, high), f"{low}-{high}")
    return out.otherwise("65+")
