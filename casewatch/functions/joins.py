"""Equi-joins in which null keys match each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", plain: Sequence[str] = ()
) -> DataFrame:
    """Join on the columns ``on`` (null equals null) and ``plain`` (null equals
    nothing); the result has each key once, from the left side. Spark plans
    ``<=>`` as an equi-join (hash or sort-merge), never as a nested loop."""
    keys = [*on, *plain]
    mine = right.select(
        *[F.col(f"`{c}`").alias(f"_rk{i}") for i, c in enumerate(keys)],
        *[F.col(f"`{c}`") for c in right.columns if c not in keys],
    )
    cond = F.lit(True)
    for i, c in enumerate(keys):
        cond = cond & (left[f"`{c}`"].eqNullSafe(mine[f"_rk{i}"]) if c in on else left[f"`{c}`"] == mine[f"_rk{i}"])
    return left.join(mine, cond, how).drop(*[f"_rk{i}" for i in range(len(keys))])
