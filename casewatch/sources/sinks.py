"""Sinks (S2, S4, S6, S7) and re-reads.

All writes are distributed: each group's document is one row and Spark
writes partitions in parallel; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def write_tables(tables: dict[str, DataFrame], out_dir: str, by: Sequence[str] = ()) -> dict[str, str]:
    """Write cases / reactions / drugs as Parquet (typed, no re-inference)."""
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if by:
            w = w.partitionBy(*by)
        w.parquet(path)
        paths[name] = path
    return paths


def read_tables(spark: SparkSession, paths: dict[str, str], schemas: dict[str, StructType]) -> dict[str, DataFrame]:
    """S3: re-read with the declared schema (never inferred)."""
    return {name: spark.read.schema(schemas[name]).parquet(p) for name, p in paths.items()}


def write_evidence_json(evidence_json: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """One JSON document per group (column ``evidence_json``)."""
    w = evidence_json.select(*by, F.col("evidence_json").alias("value")).write.mode("overwrite")
    if by:
        w = w.partitionBy(*by)
    w.text(path)


def read_evidence_text(spark: SparkSession, path: str, by: StructType | str | None = None, pretty: bool = False) -> DataFrame:
    """The documents as text (column ``value``), one a line, or one a file
    in any layout with ``pretty``. ``by`` declares the group columns of folders
    that S4 made per group; without it they come back as text, as their folders
    are named. Their types are never guessed ("007" stays what it is)."""
    if by is None:
        named = [c for c in spark.read.text(path, wholetext=pretty).columns if c != "value"]
        by = StructType([StructField(c, StringType()) for c in named])
    groups = by if isinstance(by, StructType) else StructType.fromDDL(by)
    schema = StructType([StructField("value", StringType()), *groups.fields])
    return spark.read.schema(schema).text(path, wholetext=pretty).select(*groups.names, "value")


def read_evidence_json(
    spark: SparkSession, path: str, schema: StructType, by: StructType | str | None = None, pretty: bool = False
) -> DataFrame:
    """Documents of a known shape, parsed; anything but an object fails the job."""
    raw = read_evidence_text(spark, path, by, pretty)
    keys = [F.col(f"`{c}`") for c in raw.columns if c != "value"]
    return raw.select(*keys, F.from_json("value", schema, {"mode": "FAILFAST"}).alias("evidence"))


def write_report(report: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """One Markdown document per group."""
    w = report.select(*by, F.col("report").alias("value")).write.mode("overwrite")
    if by:
        w = w.partitionBy(*by)
    w.text(path)


def write_counters(counters: DataFrame, path: str) -> None:
    """Run counters (a handful of rows) as JSON lines."""
    counters.write.mode("overwrite").json(path)


def write_audit(audit: DataFrame, path: str) -> None:
    """Every section record as one JSON line. The evidence stands in it as
    the text it has, an object with its keys in evidence order and its numbers as
    they were written."""
    opts = {"ignoreNullFields": "false"}
    at = audit.columns.index("evidence")
    before, after = audit.columns[:at], audit.columns[at + 1 :]

    def fields(names: Sequence[str]) -> Column:
        inside = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), opts)
        return F.substring(inside, F.lit(2), F.length(inside) - 2)

    evidence = F.concat(F.lit('"evidence":'), F.coalesce("evidence", F.lit("null")))
    parts = [*([fields(before)] if before else []), evidence, *([fields(after)] if after else [])]
    line = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    audit.select(line.alias("value")).write.mode("overwrite").text(path)
