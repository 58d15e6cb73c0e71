"""The corpus pipeline: five stages over ``documents``, each one calling one
of the operators in ``casewatch.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm import decontamination, langid, mixing, sharding, simhash
from casewatch.llm.common import Workspace, table


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that language ID rejects."""
    return langid.keep_identified(docs, Workspace(spark, "stage6"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash class, the one with the smallest id."""
    return simhash.keep_one(docs, Workspace(spark, "stage9"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop every document that holds a verified benchmark passage."""
    found = decontamination.find_overlaps(docs, table(spark, sf_dir, "benchmark"), Workspace(spark, "stage7"))
    leaked = found.select("text_key").distinct()
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumn("__llm_key", key).join(leaked, F.col("__llm_key") == leaked["text_key"], "left_anti").drop("__llm_key")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the documents in mixed order: sources interleave by target weight."""
    return mixing.mix(docs).orderBy("mix_position").select(*docs.columns)


def stage_shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add each document's shard and its place in the mixed order. Row order does
    not outlive a table that is written and read again, so the place is worked
    out from the documents, as in the mixing stage."""
    return sharding.with_shard(mixing.mix(docs).drop("mix_block", "mix_slot"), sharding.SHARDS)


STAGES = [
    ("language_id", stage_language),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontaminate),
    ("mixing", stage_mix),
    ("sharding", stage_shard),
]

#: SQL has neither the language models nor the fingerprints' components; the
#: tests hold each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = work.put(stage(spark, docs, sf_dir), f"{i}_{name}")
    return docs
