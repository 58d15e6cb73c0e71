"""Number extraction from text (grounding checks)."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewatch.config import NUMBER_PATTERN

#: The decimal digits of every script, and the ASCII digit of each.
_DIGITS = "".join(chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd")
_ASCII = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def extract_numbers(text: str | Column, pattern: str = NUMBER_PATTERN) -> Column:
    """All matches of the number pattern, left to right; null/empty -> []."""
    t = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(found)


def number_value(token: str | Column) -> Column:
    """Drop ',' and '%', read as double (the reference compares normalized
    number text; for these tokens equal doubles <=> equal normalized text).
    Digits of other scripts count as the ASCII digits of the same value."""
    t = F.col(token) if isinstance(token, str) else token
    plain = F.regexp_replace(t, "[,%]", "")
    return F.when(F.octet_length(t) == F.length(t), plain).otherwise(F.translate(plain, _DIGITS, _ASCII)).try_cast("double")
