"""Raw scan with two outputs (S1): rows that could be read, and a table of
those that could not. No line vanishes and no cell moves to another column.

Lines are read as text, so nothing is inferred. A CSV line is cut into cells by
one expression and laid out by the header of its own file, whatever the column
order of other files; a JSON line becomes a map of name to text. What does not fit
goes to the violations with its file, its line and the reason.

Columns are text throughout. Which columns there are is declared, or found by one
pass over the header lines (CSV) or over the names of all objects (JSON).
A file's header is the line that holds every required column; the pass that finds
it passes over other lines after one substring test.

A cell with a line break spans lines here and is a violation of each; such files
are read with ``read_raw(..., multiline=True)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.config import NULL_SENTINELS, REQUIRED_RAW_COLUMNS
from casewatch.sources.raw import require_columns, sentinels_to_null

#: Reasons of the violations table.
BROKEN_QUOTES = "quotes do not match"
RAGGED = "the number of cells differs from the header's"
NO_HEADER = "the file has no header with the required columns"
TWO_HEADERS = "the file has different headers"
REPEATED_NAME = "a column name is repeated"
NOT_AN_OBJECT = "not a complete JSON object"

#: A comma and the cell behind it, quoted or not.
_CELL = r',("[^"]*+(?:""[^"]*+)*+"|[^,"]*+)'


@dataclass
class RawScan:
    """``rows``: source_file and the columns, as text. ``violations``:
    source_file, reason, line."""

    rows: DataFrame
    violations: DataFrame


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(source_file, line)`` of every line that is not blank."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))
    return _not_blank(lines)


def _not_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("line").isNotNull() & (F.trim("line") != ""))


def _names(cells: Column) -> Column:
    return F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))


def csv_cells(line: Column) -> Column:
    """The cells of a line: a quoted cell without its quotes, an empty one
    without quotes null; null when quotes do not match."""
    from_start = F.concat(F.lit(","), F.regexp_replace(line, "^﻿", ""))
    found = F.regexp_extract_all(from_start, F.lit(_CELL), F.lit(1))
    whole = F.concat(F.lit(","), F.array_join(found, ",")) == from_start

    def cell(c: Column) -> Column:
        inside = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        return F.when(c.startswith('"'), inside).otherwise(F.nullif(c, F.lit("")))

    return F.when(whole, F.transform(found, cell))


def csv_headers(lines: DataFrame, required: Sequence[str]) -> DataFrame:
    """``(source_file, names, other)``: normalized names of each file's header;
    ``other`` differs from ``names`` when the file has several."""
    likely = lines.where(F.contains(F.lower("line"), F.lit(required[0]))) if required else lines
    named = likely.select("source_file", _names(csv_cells(F.col("line"))).alias("names"))
    held = named.where(_is_header(F.col("names"), required))
    return held.groupBy("source_file").agg(F.min("names").alias("names"), F.max("names").alias("other"))


def _is_header(names: Column, required: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(c) for c in required])
    return F.coalesce(F.size(F.array_except(wanted, names)) == 0, F.lit(False))


def parse_csv(lines: DataFrame, required: Sequence[str] = REQUIRED_RAW_COLUMNS, columns: Sequence[str] | None = None) -> RawScan:
    """``lines`` (source_file, line) of any number of files, each with a header."""
    lines = _not_blank(lines)
    headers = csv_headers(lines, required)
    if columns is None:
        columns = sorted(r[0] for r in headers.select(F.explode("names")).distinct().collect())  # names only
    cells = lines.select("source_file", "line", csv_cells(F.col("line")).alias("cells"))
    cells = cells.where(~_is_header(_names(F.col("cells")), required))
    laid = cells.join(headers, "source_file", "left")
    reason = (
        F.when(F.col("names").isNull(), NO_HEADER)
        .when(F.col("names") != F.col("other"), TWO_HEADERS)
        .when(F.size("names") != F.size(F.array_distinct("names")), REPEATED_NAME)
        .when(F.col("cells").isNull(), BROKEN_QUOTES)
        .when(F.size("cells") != F.size("names"), RAGGED)
    )
    return _scan(laid.withColumn("reason", reason), F.map_from_arrays("names", "cells"), columns, required)


def parse_json(
    lines: DataFrame,
    required: Sequence[str] = REQUIRED_RAW_COLUMNS,
    columns: Sequence[str] | None = None,
    strict: bool = False,
) -> RawScan:
    """``lines`` (source_file, line) with one object each. A list becomes a
    packed cell, any other nested value its JSON text; numbers come as Spark
    writes them (7.50 as 7.5). With ``strict`` a job that
    reads ``rows`` fails at the first violation."""
    lines = _not_blank(lines)
    entries = F.map_entries(F.from_json("line", "map<string,string>"))
    found = lines.select("source_file", "line", entries.alias("entries"))
    found = found.withColumn("names", _names(F.transform("entries", lambda e: e["key"])))
    if columns is None:
        columns = sorted(r[0] for r in found.select(F.explode("names")).distinct().collect())  # names only
    reason = F.when(F.col("entries").isNull(), NOT_AN_OBJECT).when(
        F.size("names") != F.size(F.array_distinct("names")), REPEATED_NAME
    )

    def value(e: Column) -> Column:
        packed = F.array_join(F.from_json(e["value"], "array<string>"), ",", "")
        return F.when(e["value"].startswith("["), F.coalesce(packed, e["value"])).otherwise(e["value"])

    cells = F.map_from_arrays("names", F.transform("entries", value))
    return _scan(found.withColumn("reason", reason), cells, columns, required, strict)


def _scan(laid: DataFrame, cells: Column, columns: Iterable[str], required: Sequence[str], strict: bool = False) -> RawScan:
    fits = F.col("reason").isNull()
    if strict:
        message = F.concat(F.col("reason"), F.lit(": "), F.substring("line", 1, 200))
        fits = F.when(fits, F.lit(True)).otherwise(F.raise_error(message).isNotNull())
    good = laid.where(fits).select("source_file", cells.alias("cells"))
    rows = good.select("source_file", *[F.element_at("cells", F.lit(c)).alias(c) for c in columns])
    return RawScan(require_columns(rows, required), laid.where(F.col("reason").isNotNull()).select("source_file", "reason", "line"))


def read_raw_checked(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    required: Sequence[str] = REQUIRED_RAW_COLUMNS,
    columns: Sequence[str] | None = None,
    null_sentinels: Iterable[str] = NULL_SENTINELS,
) -> RawScan:
    """S1 with violations for ``csv`` or ``json`` (one object a line) files."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"No line format: {fmt}")
    parse = parse_csv if fmt == "csv" else parse_json
    scan = parse(text_lines(spark, path), required, columns)
    data = [c for c in scan.rows.columns if c != "source_file"]
    return RawScan(sentinels_to_null(scan.rows, null_sentinels, data), scan.violations)
