"""Raw wide-table scan (S1) with header normalization (C1) and the
required-column check (C4).

Every raw column is read as text: no type inference, so flag codes such as
``1`` never turn into ``1.0`` (a documented divergence, see README).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.config import NULL_SENTINELS, REQUIRED_RAW_COLUMNS


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip + lower-case every column name; duplicates after that -> error."""
    names = [c.strip().lower() for c in df.columns]
    seen: set[str] = set()
    dups: list[str] = []
    for n in names:
        if n in seen and n not in dups:
            dups.append(n)
        seen.add(n)
    if dups:
        raise ValueError(f"Column names that are equal once normalized: {dups}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_RAW_COLUMNS) -> DataFrame:
    """Raise listing every missing required column (metadata only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError("Missing required columns: " + ", ".join(missing))
    return df


def sentinels_to_null(df: DataFrame, sentinels: Iterable[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Markers of a missing value become null, in ``columns`` (default: all)."""
    values = list(sentinels)
    if not values:
        return df
    held = df.columns if columns is None else columns
    missing = lambda c: F.when(F.col(f"`{c}`").isin(values), F.lit(None).cast("string"))
    return df.select(*[missing(c).otherwise(F.col(f"`{c}`")).alias(c) if c in held else F.col(f"`{c}`") for c in df.columns])


def read_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    required: Sequence[str] = REQUIRED_RAW_COLUMNS,
    null_sentinels: Iterable[str] = NULL_SENTINELS,
    multiline: bool = False,
) -> DataFrame:
    """Load the wide case table with every column as string.

    CSV/JSON are read without inference; Parquet/ORC columns are cast to
    string. A JSON line that is no object fails the job (``read_raw_checked``
    sets such lines aside instead). ``multiline`` reads CSV cells and JSON documents that hold line
    breaks, one task a file; without it files are split. A missing path raises Spark's PATH_NOT_FOUND naming the path.
    """
    if fmt == "csv":
        df = (
            spark.read.option("header", "true")
            .option("inferSchema", "false")
            .option("multiLine", str(multiline).lower())
            .option("escape", '"')
            .csv(path)
        )
    elif fmt == "json" and not multiline:
        from casewatch.sources.quarantine import parse_json, text_lines

        # a map of names to text: no schema is inferred
        df = parse_json(text_lines(spark, path), required, strict=True).rows.drop("source_file")
    elif fmt == "json":
        df = spark.read.option("primitivesAsString", "true").option("multiLine", "true").json(path)
    else:
        df = spark.read.format(fmt).load(path)
    df = normalize_headers(df)
    df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    df = sentinels_to_null(df, null_sentinels)
    return require_columns(df, required)
