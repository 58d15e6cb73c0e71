"""Cleaning and projection operators (C1-C17) as DataFrame -> DataFrame.

Every operator is a single ``select`` of built-in expressions: narrow, no
shuffle, inside one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from casewatch.config import CASE_COLUMNS, CATEGORICAL_COLUMNS
from casewatch.functions import (
    age_band,
    age_in_years,
    clean_text,
    lower_strip,
    parse_date,
)
from casewatch.functions.numeric import plain_number, whole_number


def _q(c: str):
    return F.col(f"`{c}`")


def clean_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """C2 + C3 (+ C6): blank -> null, then strip, for every string column."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)
    }
    return df.select(*[(clean_text(_q(c)) if c in targets else _q(c)).alias(c) for c in df.columns])


def coerce_numeric(df: DataFrame, id_col: str = "safetyreportid", version_col: str = "safetyreportversion") -> DataFrame:
    """Id -> nullable long (whole numbers in any plain notation, such as
    ``1001``, ``1001.0`` or ``1.001E3``; others -> null); version -> double
    with null -> 0."""
    out = []
    for c in df.columns:
        if c == id_col:
            out.append(whole_number(_q(c)).alias(c))
        elif c == version_col:
            out.append(F.coalesce(plain_number(_q(c)), F.lit(0.0)).alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)


def select_present(df: DataFrame, columns: Sequence[str] = CASE_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the listed columns that exist (plus ``keep``, e.g. group keys)."""
    wanted = [c for c in keep if c in df.columns] + [c for c in columns if c in df.columns and c not in keep]
    return df.select(*[_q(c) for c in wanted])


def normalize_categoricals(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS, stripped: bool = False
) -> DataFrame:
    """Lower + strip the listed columns that are present
    (``stripped=True``: the input already went through ``clean_columns``)."""
    cols = set(columns)
    norm = (lambda c: F.lower(_q(c))) if stripped else (lambda c: lower_strip(_q(c)))
    return df.select(*[(norm(c) if c in cols else _q(c)).alias(c) for c in df.columns])


def add_report_date(df: DataFrame, column: str = "report_date") -> DataFrame:
    """Parse the report date text in place (DateType)."""
    if column not in df.columns:
        return df
    return df.withColumn(column, parse_date(_q(column)))


def add_age(
    df: DataFrame,
    age_col: str = "patient_patientonsetage",
    unit_col: str = "patient_patientonsetageunit",
) -> DataFrame:
    """``age``, ``age_unit``, ``age_years``, ``age_group``."""
    age = (
        plain_number(_q(age_col))
        if age_col in df.columns
        else F.lit(None).cast("double")
    )
    unit = lower_strip(_q(unit_col)) if unit_col in df.columns else F.lit(None).cast("string")
    return (
        df.withColumn("age", age)
        .withColumn("age_unit", unit)
        .withColumn("age_years", age_in_years(F.col("age"), F.col("age_unit")))
        .withColumn("age_group", age_band(F.col("age_years")))
    )


def prepare_cases(latest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Case table from the newest-version rows (already cleaned by
    ``clean_columns``): C7, C9, C10-C12, C8."""
    cases = select_present(latest, CASE_COLUMNS, keep=by)
    cases = add_report_date(cases)
    cases = add_age(cases)
    return normalize_categoricals(cases, [c for c in CATEGORICAL_COLUMNS if c not in by], stripped=True)


def validate_tables(
    cases: DataFrame,
    reactions: DataFrame,
    drugs: DataFrame,
    key: str = "safetyreportid",
) -> None:
    """Required columns on the three tables (metadata only), then one
    aggregate that looks for a duplicated case id; raises on any problem."""
    required = {
        "case": (cases, [key, "serious", "fulfillexpeditecriteria", "patient_patientsex", "age_group"]),
        "reaction": (reactions, [key, "reaction_pt"]),
        "drug": (drugs, [key, "active_substance"]),
    }
    for name, (df, cols) in required.items():
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"The {name} table lacks: " + ", ".join(missing))
    dup = cases.groupBy(_q(key)).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    if not dup.isEmpty():
        raise ValueError(f"A case id ({key}) occurs in several rows of the case table.")
