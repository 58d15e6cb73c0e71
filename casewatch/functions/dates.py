"""Date parsing that follows the reference's rules without Python row code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewatch.config import DATE_FORMATS, DATE_REWRITES
from casewatch.functions.text import strip


def parse_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text -> DateType.

    Exactly eight digits parse as ``yyyyMMdd`` (invalid -> null). Otherwise a
    time of day is cut, dates with a month name are brought to one form, and
    the result is tried against ``formats`` in order; blank or unparsable ->
    null. ANSI mode is on in Spark 4, so only ``try_to_date`` is used.
    """
    col = F.col(c) if isinstance(c, str) else c
    s = strip(col.cast("string"))
    plain = s
    for pattern, order in DATE_REWRITES:
        plain = F.regexp_replace(plain, pattern, order)
    # every rewrite needs a letter, a colon or a blank: other texts stay as they are
    plain = F.when(s.rlike("^[0-9/-]*$"), s).otherwise(F.initcap(plain))
    free_form = F.coalesce(*[F.try_to_date(plain, f) for f in formats])
    return (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("date"))
        .when(s.rlike(r"^\d{8}$"), F.try_to_date(s, "yyyyMMdd"))
        .otherwise(free_form)
    )


def month_of(c: str | Column) -> Column:
    """Date -> ``YYYY-MM`` text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM")
