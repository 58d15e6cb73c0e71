"""Operator 1, exact dedup: a persistent digest index, bucketed and sorted by
digest; new data is deduplicated by sort-merge anti-join and appended.

Two texts are equal when they are identical once every character of
``[\\x20\\x09-\\x0D]`` is deleted. Null texts count as empty.

Index columns: digest (binary, SHA-256 of the normalised text), keep_id (the
row that stays), points (code points of its original text), group_size (rows
of the batch that brought the digest in), batch (that batch). The table is bucketed and sorted by
digest, so an anti-join reads it bucket by bucket: the index itself is never
shuffled, however large it has grown; only the new batch's digests are.

Defined results: null or empty texts form one group like any other text;
repeated rows are separate members of their group, and of rows that share the
longest text and the smallest id exactly one is kept; a null doc_id stays only
when no member has an id; in a later batch all copies of a known text are dropped
and group_size counts the rows of that batch; an empty batch appends nothing; other columns of
the input never reach the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import WHITE, Workspace, shared_dir, table


#: A digest with more than this part of a batch's rows (1 / HOT) is joined apart.
HOT = 500


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE, ""), 256))


class DigestIndex:
    """The persistent index: a bucketed Parquet table at ``path``.

    A later session that opens the same path (with the same number of
    buckets) goes on with the digests stored there."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, points INT, group_size BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def digests(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, points, digest and a row number of each row: the only
        columns that any later step moves."""
        text = F.coalesce(F.col(text_col), F.lit(""))
        return df.select(
            F.col(id_col).alias("doc_id"),
            F.length(text).alias("points"),
            digest(text).alias("digest"),
            F.monotonically_increasing_id().alias("row_no"),
        )

    def groups(self, digests: DataFrame) -> DataFrame:
        """One row a digest of a batch: longest original text, then smallest
        id, then any one row; pre-aggregated before the shuffle, so a text with
        a third of all copies costs one row a task."""
        # ~id is decreasing in id and cannot overflow; a null id sorts lowest
        best = F.max(F.struct("points", F.bitwise_not("doc_id").alias("inv"), "row_no"))
        grouped = digests.groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size"))
        return grouped.select(
            "digest",
            F.bitwise_not("b.inv").alias("keep_id"),
            F.col("b.points").alias("points"),
            F.col("b.row_no").alias("keep_row"),
            "group_size",
        )

    def append(self, groups: DataFrame) -> str:
        """Drop the digests that the index has, append the rest and return the
        name of the batch."""
        batch = uuid.uuid4().hex
        fresh = groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        fresh = fresh.select("digest", "keep_id", "points", "group_size", F.lit(batch).alias("batch"))
        (
            fresh.repartition(self.buckets, "digest")
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .saveAsTable(self.name)
        )
        return batch

    def resolve(self, digests: DataFrame, groups: DataFrame, batch: str) -> DataFrame:
        """Every row of a batch with the row that stays for its text, from the
        index, and whether it is that row. Digests with more than 1 / ``HOT`` of
        the batch's rows are at most HOT; their index rows are broadcast. The
        others are joined by merge, where only (id, row number, digest) is shuffled."""
        n = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
        hot = F.broadcast(groups.where(F.col("group_size") > n / HOT).select("digest"))
        first = F.when(F.col("batch") == batch, F.col("keep_row")).alias("first_row")
        index = self.table().select("digest", F.col("keep_id").alias("stays"), "batch")
        known = groups.select("digest", "keep_row", "group_size").join(index.hint("merge"), "digest")
        known = known.select("digest", F.col("stays").alias("keep_id"), "group_size", first)
        rows = digests.select("doc_id", "digest", "row_no")
        of_hot = rows.join(F.broadcast(known.join(hot, "digest", "left_semi")), "digest")
        found = rows.join(hot, "digest", "left_anti").join(known, "digest").unionByName(of_hot)
        return found.withColumn("kept", F.coalesce(F.col("row_no") == F.col("first_row"), F.lit(False)))


def exact_dedup(df: DataFrame, index: DigestIndex, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deduplicate one batch against the index and append what is new.

    Returns one row per input row, dropped ones too: doc_id, keep_id,
    group_size, kept, text_sha256."""
    rows = work.put(index.digests(df, id_col, text_col), "digests")
    groups = work.put(index.groups(rows), "groups")
    batch = index.append(groups)
    return index.resolve(rows, groups, batch).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op1")
    docs = table(spark, sf_dir, "documents")
    # about 8 million digests (0.4 GB) a bucket file at 100 TB; no more files than shuffle partitions
    index = DigestIndex(spark, f"{work.root}/index", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return exact_dedup(docs, index, work)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER w AS place
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id ASC NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""
