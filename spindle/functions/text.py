"""String rules as column expressions: word splitting, integer parsing, UTF-16 length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: an item line is a base-10 64-bit integer with an optional sign and nothing else.
ITEM_PATTERN = r"\A[+-]?[0-9]+\z"


def words(text: Column) -> Column:
    """Words of a document split on single spaces, keeping Java ``String.split(" ")`` semantics.

    Inner and leading empty tokens are kept as the word ``""``, trailing empty tokens are dropped, an empty
    document yields one ``""`` and a document made only of spaces yields no word.  ``rtrim`` without a trim
    string removes only U+0020, so tabs and newlines stay inside words.
    """
    stripped = F.rtrim(text)
    return F.when((text == F.lit("")) | (stripped != F.lit("")), F.split(stripped, " ")).otherwise(
        F.array().cast("array<string>")
    )


def parse_item(value: Column) -> Column:
    """``BIGINT`` for a well-formed integer line, NULL otherwise (including 64-bit overflow)."""
    return F.when(value.rlike(ITEM_PATTERN), value.try_cast("bigint"))


def utf16_length(s: Column) -> Column:
    """Length in UTF-16 code units (a character outside the BMP counts twice)."""
    return (F.length(F.encode(s, "UTF-16BE")) / F.lit(2)).cast("bigint")
