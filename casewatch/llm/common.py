"""Helpers shared by the corpus operators: table scans, staging, row numbering.

Staged tables are Parquet folders under the shared folder that the cluster
names in ``spark.checkpoint.dir``, so they outlive any executor. Only a local
session (tests) that names no folder gets one of its own.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space of every contract: blank and the five control characters 9-13.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from the session; a local session without one gets a fresh
    temporary folder, any other session must name one."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="casewatch-llm-"))
    return sc.getCheckpointDir().rstrip("/")


class Workspace:
    """Staged tables of one run, all under one new folder.

    ``put`` writes a table and reads it back, which also cuts lineage.
    ``drop`` deletes tables that nothing reads any more (earlier rounds of a
    loop); ``close`` deletes the folder once the caller has stored the result
    that reads from it."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
        """``rows_per_file`` (0: any) makes many small files of long rows, and so
        many small tasks of a step that reads them."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jvm_path, True)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.root}/{name}")

    def close(self) -> None:
        self._delete(self.root)


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Batches of at most ``n`` rows for the Python steps of the jobs that run
    inside, so that a task holds little of tables with long rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def gapless_index(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str, n_rows: int) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each group, in an order fixed by the
    hash of ``order``.

    No group is ever numbered by one task: its rows are dealt over about
    sqrt(n_rows) blocks by hash, blocks are counted (partial aggregation),
    and a row's number is the sum of the earlier blocks plus its place in its
    own block. Group columns must not be null. Rows equal in ``order`` get
    different numbers in any order."""
    blocks = max(1, math.isqrt(max(0, n_rows)))
    keyed = df.withColumn("__llm_blk", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    keys = [*groups, "__llm_blk"]
    earlier = Window.partitionBy(*groups).orderBy("__llm_blk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__llm_n"))
        .select(*keys, F.coalesce(F.sum("__llm_n").over(earlier), F.lit(0)).alias("__llm_before"))
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (
        keyed.withColumn("__llm_place", place)
        .join(before, keys)
        .withColumn(out, (F.col("__llm_before") + F.col("__llm_place")).cast("long"))
        .drop("__llm_blk", "__llm_place", "__llm_before")
    )


def id_bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def most_frequent(counts: DataFrame, n_col: str, limit: int) -> DataFrame:
    """The rows whose count is over a bound chosen so that at most ``limit``
    rows pass: a histogram of the counts in steps of 1/16 octave (a few hundred
    rows) goes to the driver, never the candidates of every partition."""
    step = F.floor(F.log2(F.col(n_col).cast("double")) * 16).cast("int")
    rows = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    kept, least = 0, None
    for r in sorted(rows, reverse=True):
        if kept + r["rows"] > limit:
            break
        kept, least = kept + r["rows"], r["step"]
    return counts.where(step >= least if least is not None else F.lit(False))
