"""Newest version per case over a file stream.

``latest_version`` is an aggregate (``max`` of a struct per key), so it runs as a
streaming aggregation: the state store keeps one buffer per case id (bounded
by the number of cases, never by the number of versions) and each micro-batch
emits the cases whose newest version changed (``update`` mode).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from casewatch.operators.clean import clean_columns, coerce_numeric
from casewatch.operators.rowset import latest_version


def newest_versions_stream(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    fmt: str = "parquet",
    key: str = "safetyreportid",
    version: str = "safetyreportversion",
    tiebreak: Sequence[str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of the newest row per case from raw files arriving
    under ``path`` (every column read as text, as in the batch scan)."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(path)
    return latest_version(coerce_numeric(clean_columns(raw), key, version), key, version, tiebreak)


def start_newest_versions(
    stream: DataFrame,
    checkpoint_location: str,
    sink: Callable[[DataFrame, int], None],
    output_mode: str = "update",
) -> StreamingQuery:
    """Start the stream. ``sink(batch_df, batch_id)`` receives each
    micro-batch of changed cases (``foreachBatch``, e.g. a MERGE into a
    table). ``checkpoint_location`` must be shared storage."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint_location)
    return writer.foreachBatch(sink).start()
