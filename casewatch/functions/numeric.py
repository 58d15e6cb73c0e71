"""Arithmetic expressions: percentages (half-even) and age handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewatch.config import AGE_BANDS, AGE_ELDERLY, AGE_UNKNOWN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percentage(part: str | Column, total: str | Column) -> Column:
    """``0.0`` when total is 0, else ``part/total*100`` rounded half-even to 2.

    ``bround`` matches Python's ``round`` on these ratios; ``round`` does not.
    """
    p = _col(part).cast("double")
    t = _col(total).cast("double")
    return F.when(t == 0, F.lit(0.0)).otherwise(F.bround((p / t) * F.lit(100.0), 2))


def age_in_years(age: str | Column, unit: str | Column) -> Column:
    """year x1, month /12, day /365.25; any other unit -> null."""
    a = _col(age)
    u = _col(unit)
    return (
        F.when(u == "year", a)
        .when(u == "month", a / F.lit(12.0))
        .when(u == "day", a / F.lit(365.25))
        .otherwise(F.lit(None).cast("double"))
    )


def age_band(years: str | Column) -> Column:
    """null -> unknown, then the fixed bands (negative ages fall in the first)."""
    y = _col(years)
    expr = F.when(y.isNull() | F.isnan(y), F.lit(AGE_UNKNOWN))
    for bound, label in AGE_BANDS:
        expr = expr.when(y < F.lit(float(bound)), F.lit(label))
    return expr.otherwise(F.lit(AGE_ELDERLY))


#: Decimal notation without names (NaN, Infinity) or type suffixes (3d, 2f).
PLAIN_NUMBER = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"


def plain_number(c: Column) -> Column:
    """Text -> double; text that is not a plain decimal number -> null."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(PLAIN_NUMBER), t.try_cast("double"))


def whole_number(c: Column) -> Column:
    """Text -> long; a number with a fraction of zero counts as whole. Digits
    alone are read exactly; other notations up to 2**53."""
    t = F.trim(c.cast("string"))
    d = plain_number(c)
    exact = d == F.floor(d).cast("double")
    return F.when(t.rlike(r"^[-+]?[0-9]+$"), t.try_cast("bigint")).when(
        exact & (F.abs(d) <= F.lit(float(1 << 53))), d.try_cast("bigint")
    )
