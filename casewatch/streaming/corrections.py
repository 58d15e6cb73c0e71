"""Counts over a stream of case versions that stay right when a case changes.

Each micro-batch is merged into stored cases (``sources.case_store``). What the
merge changes comes as old and new row of each case, so counts by any columns
are corrected: the old row's group loses a case, the new row's group gains one,
and a case that expires is taken off. Neither the stored cases nor earlier
batches are counted again.

Counts are written per generation of the store, before the merge that completes
the generation. A batch that runs again after a failure finds the store either
unmerged, and writes the same counts once more, or merged, and changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casewatch.sources.case_store import CaseStore, corrected_counts


class CorrectedCounts:
    """Counts by ``columns`` of a store's cases, under ``path``."""

    def __init__(self, store: CaseStore, path: str, columns: Sequence[str]):
        self.store, self.path, self.columns = store, path.rstrip("/"), list(columns)

    def counts(self) -> DataFrame:
        """``(columns..., n)`` over the stored cases."""
        held = self.store.generations()
        if held:
            fields = [self.store.schema[c] for c in self.columns]
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n long"
            return self.store.spark.read.schema(ddl).parquet(f"{self.path}/{held[-1]}")
        return self.store.cases().select(*self.columns, F.lit(0).cast("long").alias("n"))

    def take(self, batch: DataFrame, batch_id: int = 0) -> None:
        """Merge one micro-batch and correct the counts (a ``foreachBatch`` sink)."""
        held = self.store.generations()
        following = held[-1] + 1 if held else 0
        after = corrected_counts(self.counts(), self.store.changes(batch), self.columns)
        after.write.mode("overwrite").parquet(f"{self.path}/{following}")
        self.store.merge(batch)


def start_corrected_counts(stream: DataFrame, counts: CorrectedCounts, checkpoint_location: str) -> StreamingQuery:
    """Start the stream of raw case versions (cleaned, with the store's columns).
    ``checkpoint_location`` must be shared storage."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint_location)
    return writer.foreachBatch(counts.take).start()
