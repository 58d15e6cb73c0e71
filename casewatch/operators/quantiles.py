"""Quantiles of a number per group (A4), exactly and from stored sketches.

Exact: equal values are counted first (partial aggregation), and the rank that
a quantile asks for is found by running sums over counts. Values are dealt into
bins that rise with the value (64 an octave, so some 260,000 at most whatever the
data); one running sum goes over the bins of a group, the second over the values
of the bins that hold a wanted rank. No task holds the values of a group in a
buffer, as ``percentile`` and ``median`` do.

Sketches: a KLL sketch per group and period is a column that is stored, and merged
later into any coarser group, also with sketches of data that came in since; the
rows themselves are not read again. ``RANK_ERROR`` bounds the error of a rank (as a
share of all values) for ``SKETCH_K`` with a chance of failure under one in a million.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.functions.joins import join_null_safe
from casewatch.operators.metrics import drop_group, keys, with_group

BINS_AN_OCTAVE = 64
SKETCH_K = 400
RANK_ERROR = 0.03

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _bin(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises."""
    size = F.floor(F.log2(F.abs(v)) * BINS_AN_OCTAVE).cast("int") + 1100 * BINS_AN_OCTAVE
    return F.when(v > 0, size).when(v < 0, -size).otherwise(0)


def number_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., value, n)``: each non-null number of a group with its count."""
    base = with_group(df, by).select(*[_q(k) for k in keys(by)], _q(column).cast("double").alias("value"))
    counted = base.where(F.col("value").isNotNull()).groupBy(*[_q(k) for k in keys(by)], "value")
    return counted.agg(F.count(F.lit(1)).alias("n"))


def quantiles_from_counts(counts: DataFrame, probs: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """``(by..., n, <name of each quantile>)`` from ``(by..., value, n)``; a value
    between two ranks is interpolated. ``by`` must not be empty."""
    group = [_q(k) for k in by]
    binned = counts.withColumn("bin", _bin(F.col("value")))
    bins = binned.groupBy(*group, "bin").agg(F.sum("n").alias("_held"))
    earlier = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        *group,
        "bin",
        "_held",
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_held").over(Window.partitionBy(*group)).alias("_all"),
    )
    place = {name: (F.col("_all") - 1) * F.lit(p) for name, p in probs.items()}
    ranks = [r.cast("long") for at in place.values() for r in (F.floor(at), F.ceil(at))]
    asked = F.lit(False)
    for r in ranks:
        asked = asked | ((F.col("_start") <= r) & (r < F.col("_start") + F.col("_held")))
    near = join_null_safe(binned, bins.where(asked).drop("_held"), by, "inner", plain=["bin"])
    before = Window.partitionBy(*group, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_from", F.col("_start") + F.coalesce(F.sum("n").over(before), F.lit(0)))

    def at_rank(r: Column) -> Column:
        return F.max(F.when((F.col("_from") <= r) & (r < F.col("_from") + F.col("n")), F.col("value")))

    picked = near.groupBy(*group).agg(
        F.max("_all").alias("_all"), *[at_rank(r).alias(f"_v{i}") for i, r in enumerate(ranks)]
    )
    out = []
    for i, (name, at) in enumerate(place.items()):
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        mixed = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        out.append(F.when(F.floor(at) == F.ceil(at), low).otherwise(mixed).alias(name))
    return picked.select(*group, F.col("_all").alias("n"), *out)


def exact_quantiles(df: DataFrame, column: str, probs: Mapping[str, float] = QUARTILES, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, <name of each quantile>)``; a group without a number has no row."""
    return drop_group(quantiles_from_counts(number_counts(df, column, by), probs, keys(by)), by)


# -- stored sketches ------------------------------------------------------------

def number_sketches(df: DataFrame, column: str, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``(by..., sketch)``: one KLL sketch per group, a few kilobytes each."""
    known = df.where(_q(column).isNotNull())
    return known.groupBy(*[_q(c) for c in by]).agg(F.kll_sketch_agg_double(_q(column).cast("double"), F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), *more: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Sketches of coarser groups from those of finer ones, of any number of
    tables with the same columns."""
    for part in more:
        sketches = sketches.unionByName(part)
    merged = with_group(sketches, by).groupBy(*[_q(c) for c in keys(by)])
    return drop_group(merged.agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")), by)


def sketch_quantiles(sketches: DataFrame, probs: Mapping[str, float] = QUARTILES, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, <name of each quantile>)`` from one sketch per group; n is exact."""
    return sketches.select(
        *[_q(c) for c in by],
        F.kll_sketch_get_n_double("sketch").alias("n"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in probs.items()],
    )


def rank_errors(quantiles: DataFrame, counts: DataFrame, probs: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """``(by..., <name>_error)``: how far the share of values up to each quantile
    is from what was asked for, by the exact counts. ``by`` must not be empty."""
    both = join_null_safe(counts, quantiles.drop("n"), by, "inner")
    sums = [F.sum("n").alias("_n")]
    for name in probs:
        sums += [
            F.sum(F.when(F.col("value") < F.col(name), F.col("n")).otherwise(0)).alias(f"_under_{name}"),
            F.sum(F.when(F.col("value") <= F.col(name), F.col("n")).otherwise(0)).alias(f"_to_{name}"),
        ]
    seen = both.groupBy(*[_q(c) for c in by]).agg(*sums)

    def error(name: str, p: float) -> Column:
        under, upto = F.col(f"_under_{name}") / F.col("_n"), F.col(f"_to_{name}") / F.col("_n")
        return F.greatest(under - p, p - upto, F.lit(0.0)).alias(f"{name}_error")

    return seen.select(*[_q(c) for c in by], *[error(name, p) for name, p in probs.items()])
