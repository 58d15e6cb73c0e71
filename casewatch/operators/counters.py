"""Run counters (D11) as side results of writes that happen anyway.

``observe`` adds an aggregate to the rows that a write passes on, so a counter
costs no scan of its own. A task that runs again after an executor is lost
reports its rows once only in the last stage of a job, where the write is; a
counter below a shuffle could be too high. So the number of raw rows is not
watched at the scan: the version pick counts the rows of each case in its own
aggregate, and the sum of these counts is watched at the write.

For counters per group use ``operators.rowset.pipeline_counters``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casewatch.config import DEFAULT_TARGET_PATTERN
from casewatch.operators.rowset import target_match

#: Column with the number of raw rows of a case.
ROWS = "_raw_rows"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


class RunCounters:
    """Counters of one run. Each watched table must be written (or read to its
    end by another action) before ``values``."""

    def __init__(self) -> None:
        self._watched: list[Observation] = []

    def _watch(self, df: DataFrame, **counters: Column) -> DataFrame:
        self._watched.append(Observation())
        exprs = [F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in counters.items()]
        return df.observe(self._watched[-1], *exprs)

    def watch_versions(
        self, latest: DataFrame, substance_col: str, pattern: str = DEFAULT_TARGET_PATTERN, key: str = "safetyreportid"
    ) -> DataFrame:
        """``latest`` from ``latest_version(..., rows_col=ROWS)``: raw_rows,
        unique_ids, cases with and without the target."""
        match = target_match(substance_col, pattern)
        return self._watch(
            latest,
            raw_rows=F.sum(ROWS),
            unique_ids=F.count(_q(key)),
            cases_with_target=F.count_if(match),
            cases_without_target=F.count_if(~match),
        )

    def watch_rows(self, df: DataFrame, name: str) -> DataFrame:
        return self._watch(df, **{name: F.count(F.lit(1))})

    def values(self) -> dict[str, int]:
        return {name: n for o in self._watched for name, n in o.get.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """``(counter, value)``: one row per counter."""
        return spark.createDataFrame(list(self.values().items()), "counter string, value long")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(counter, value)``: the rows of tables that are not written."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("counter"), "value")
        out = part if out is None else out.unionByName(part)
    return out
