"""String expressions: Unicode strip, blank handling, set membership, packed lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# `trim` only removes U+0020; the reference strips every character for which
# Python's str.isspace() holds. The set is derived from that rule at import.
WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading/trailing Unicode whitespace (Python ``str.strip``):
    a character-set trim, no regex."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c: str | Column) -> Column:
    """Whitespace-only or empty text becomes null; other values untouched."""
    col = _col(c)
    return F.when(col.rlike(r"(?U)^\s*$"), F.lit(None).cast("string")).otherwise(col)


def clean_text(c: str | Column) -> Column:
    """Null/blank -> null, otherwise stripped."""
    return F.nullif(strip(c), F.lit(""))


def lower_strip(c: str | Column) -> Column:
    return F.lower(strip(c))


def normalize_string(c: str | Column) -> Column:
    """Text, stripped and lower-cased; null stays null."""
    return F.lower(strip(c))


def is_in_set(c: str | Column, values: Iterable[str]) -> Column:
    """Normalized membership test; null -> false."""
    return F.coalesce(normalize_string(c).isin(list(values)), F.lit(False))


def split_packed(c: str | Column, is_array: bool = False) -> Column:
    """Packed comma list -> array of stripped items.

    Null or blank -> empty array; empty items between commas are kept.
    With ``is_array`` the column is a list already: its items are stripped.
    """
    col = _col(c)
    if is_array:
        return F.coalesce(F.transform(col, lambda x: strip(x)), F.array().cast("array<string>"))
    items = F.split(col, ",")
    return F.when(col.isNull() | col.rlike(r"(?U)^\s*$"), F.array().cast("array<string>")).otherwise(
        F.transform(items, lambda x: strip(x))
    )
