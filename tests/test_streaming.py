"""Newest-version pick as a streaming aggregation."""

import tempfile

from casewatch.streaming import newest_versions_stream, start_newest_versions
from sample_rows import COLUMNS, ROWS


def test_stream_keeps_newest_version(spark):
    src = tempfile.mkdtemp(prefix="casewatch-stream-src-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="casewatch-stream-ckpt-", dir="/tmp")
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    spark.createDataFrame([ROWS[0], ROWS[2]], schema).write.mode("append").parquet(src)
    stream = newest_versions_stream(spark, src, COLUMNS)
    out = tempfile.mkdtemp(prefix="casewatch-stream-out-", dir="/tmp") + "/newest"
    q = start_newest_versions(stream, ckpt, lambda df, _: df.write.mode("overwrite").parquet(out), output_mode="complete")
    try:
        q.processAllAvailable()
        first = {r["safetyreportid"]: r["safetyreportversion"] for r in spark.read.parquet(out).collect()}
        assert first == {1001: 1.0, 1002: 1.0}
        spark.createDataFrame([ROWS[1], ROWS[3], ROWS[4]], schema).write.mode("append").parquet(src)
        q.processAllAvailable()
        second = {r["safetyreportid"]: r["safetyreportversion"] for r in spark.read.parquet(out).collect()}
        assert second == {1001: 2.0, 1002: 1.0, 1003: 1.0, 2001: 1.0}
    finally:
        q.stop()
