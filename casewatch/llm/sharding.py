"""Operator 3, sharding: jump consistent hashing from stable keys to shards.

A key's shard comes from a chain of pseudo-random jumps seeded by the key; no
ring table exists and adding a shard moves a key only into the new shard, with
probability 1/(n+1). The chain is folded with built-in expressions, and one
fold gives the shard among n and among n+1 shards.

``slot`` numbers a shard's rows from 0 without gaps. The law is ``key``: the
id and the number of shards decide.

Defined results: rows with equal ids share a shard; rows with a null id share
the shard of the null key; null texts have size 16 and the CRC of the empty
text; repeated rows get slots of their own; an empty table gives an empty
result; other columns of the input never reach the result of ``assign``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import Workspace, gapless_index, table

SHARDS = 40


def jump(key: Column, shards: int) -> Column:
    """struct(shard, grown): the key's shard among ``shards`` and ``shards + 1``.

    Step: from shard b, draw r in (0, 1] and jump to floor((b + 1) / r); the
    last shard below the limit holds the key. Shards strictly increase, so
    ``shards + 1`` steps always suffice and later steps change nothing."""

    def step(s: Column, _: Column) -> Column:
        h = F.xxhash64(s["h"])
        r = (F.shiftrightunsigned(h, 33) + 1) / F.lit(float(1 << 31))
        moved = F.struct(
            h.alias("h"),
            F.when(s["next"] < shards, s["next"]).otherwise(s["shard"]).alias("shard"),
            s["next"].alias("grown"),
            F.floor((s["next"] + 1) / r).alias("next"),
        )
        return F.when(s["next"] > shards, s).otherwise(moved)

    zero = F.lit(0).cast("long")
    start = F.struct(key.alias("h"), zero.alias("shard"), zero.alias("grown"), zero.alias("next"))
    end = lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step, end)


def with_shard(df: DataFrame, shards: int, id_col: str = "doc_id") -> DataFrame:
    """Every column of ``df`` plus ``shard`` and ``grown_shard`` (an input
    column of these names is replaced). No shuffle."""
    j = jump(F.xxhash64(F.col(id_col)), shards)
    return (
        df.withColumn("__llm_jump", j)
        .withColumn("shard", F.col("__llm_jump.shard"))
        .withColumn("grown_shard", F.col("__llm_jump.grown"))
        .drop("__llm_jump")
    )


def assign(df: DataFrame, work: Workspace, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard. The text is read once and never shuffled."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = work.put(with_shard(rows, shards), "rows")
    return gapless_index(rows, ["shard"], ["doc_id", "text_crc32", "size"], "slot", rows.count())


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assign(table(spark, sf_dir, "documents"), Workspace(spark, "op3"))
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
