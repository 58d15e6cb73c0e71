"""Distinct terms (A7) from HyperLogLog sketches that are stored and united.

``count_distinct`` of a period needs every term of it again when a period is
added or groups are merged. A sketch per (group, month) is a few kilobytes, and
the sketch of a year, of all groups, or of old and new deliveries together is
the union of theirs. The relative standard error is 1.04 / sqrt(2 ** LG_K).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.functions import month_of
from casewatch.operators.metrics import drop_group, keys, with_group

LG_K = 13
#: Five standard errors.
RELATIVE_ERROR = 5 * 1.04 / 2 ** (LG_K / 2)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def term_sketches(
    reactions: DataFrame,
    by: Sequence[str] = (),
    term_col: str = "reaction_pt",
    date_col: str = "case_report_date",
    lg_k: int = LG_K,
) -> DataFrame:
    """``(by..., month, occurrences, terms)`` over non-blank terms; ``terms`` is
    the sketch, the month is null for undated rows."""
    named = reactions.where(_q(term_col).isNotNull() & (_q(term_col) != ""))
    grouped = named.groupBy(*[_q(c) for c in by], month_of(_q(date_col)).alias("month"))
    return grouped.agg(F.count(F.lit(1)).alias("occurrences"), F.hll_sketch_agg(_q(term_col), F.lit(lg_k)).alias("terms"))


def unite_terms(sketches: DataFrame, by: Sequence[str] = (), *more: DataFrame) -> DataFrame:
    """``(by..., occurrences, terms)`` of coarser groups, from the sketches of
    any number of tables with the same columns."""
    for part in more:
        sketches = sketches.unionByName(part)
    grouped = with_group(sketches, by).groupBy(*[_q(c) for c in keys(by)])
    return drop_group(grouped.agg(F.sum("occurrences").alias("occurrences"), F.hll_union_agg("terms").alias("terms")), by)


def estimated_terms(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., total_reaction_occurrences, unique_reaction_terms)``: the first
    exact, the second within RELATIVE_ERROR."""
    return sketches.select(
        *[_q(c) for c in by],
        F.col("occurrences").alias("total_reaction_occurrences"),
        F.hll_sketch_estimate("terms").alias("unique_reaction_terms"),
    )
