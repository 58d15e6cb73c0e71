"""Aggregations (A1-A21) — every one groupable by ``by=[...]``.

Shape choices for scale:
* all case-level scalars (A1, A3, A4, A15, A17, A18) come from ONE
  ``groupBy(by).agg(...)`` pass with partial aggregation;
* marginal distributions (A5, A6, A14) are one ``unpivot`` + one groupBy;
* top-N per group uses ``row_number() <= n`` which Catalyst turns into a
  partial ``WindowGroupLimit`` before the exchange, so no task ever sees more
  than n rows per group and partition;
* a per-group denominator is summed from the counts of the same aggregate
  (no join, no driver-side ``count()``).

With ``by=()`` a constant key ``_g`` stands in, so the same plans apply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewatch.config import (
    ALERT_INTERPRETATIONS,
    FIXED_LIMITATIONS,
    FLAG_VALUES,
    MISSING_AGE_NOTE,
    MISSING_DATE_NOTE,
    MISSING_SEX_NOTE,
    NON_SERIOUS_VALUES,
    REACTION_SERIOUS_VALUES,
    SERIOUS_VALUES,
    SERIOUSNESS_COLUMNS,
    SERIOUSNESS_FLAGS,
    TOP_K_CONCENTRATION,
    TOP_N,
    UNKNOWN_VALUE,
)
from casewatch.functions import is_in_set, month_of, percentage, strip

GROUP = "_g"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def keys(by: Sequence[str]) -> list[str]:
    return list(by) if by else [GROUP]


def with_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.withColumn(GROUP, F.lit(0))


def drop_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.drop(GROUP)


def _date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# -- case-level scalars: one pass ---------------------------------------------

def case_metrics(cases: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group with every case-level scalar metric.

    Columns (nulls where the source column is absent):
      total_unique_cases, serious_cases, non_serious_cases, unknown_seriousness,
      expedite_alert_cases, <flag>_available/<flag>_count for the six flags,
      age_available_cases, age_missing_cases, age_min/max/mean,
      missing_age, missing_sex, missing_dates, start_date, end_date,
      number_of_months, and the percentages.
    """
    cols = set(cases.columns)
    present = [c for c in SERIOUSNESS_COLUMNS if c in cols]
    serious = F.lit(False)
    for c in present:
        serious = serious | is_in_set(c, SERIOUS_VALUES)
    non_serious = is_in_set("serious", NON_SERIOUS_VALUES) if "serious" in cols else F.lit(False)
    expedite = (
        is_in_set("fulfillexpeditecriteria", FLAG_VALUES) if "fulfillexpeditecriteria" in cols else F.lit(False)
    )
    age = F.col("age_years") if "age_years" in cols else F.lit(None).cast("double")
    date = F.col("report_date") if "report_date" in cols else F.lit(None).cast("date")
    sex = _q("patient_patientsex") if "patient_patientsex" in cols else F.lit(None).cast("string")

    aggs = [
        F.count(F.lit(1)).alias("total_unique_cases"),
        F.count_if(serious).alias("serious_cases"),
        F.count_if(non_serious).alias("non_serious_cases"),
        F.count_if(~(serious | non_serious)).alias("unknown_seriousness"),
        F.count_if(expedite).alias("expedite_alert_cases"),
        F.count(age).alias("age_available_cases"),
        F.count_if(age.isNull()).alias("age_missing_cases"),
        F.min(age).alias("_age_min"),
        F.max(age).alias("_age_max"),
        F.avg(age).alias("_age_mean"),
        F.count_if(sex.isNull()).alias("missing_sex"),
        F.count_if(date.isNull()).alias("missing_dates"),
        F.min(date).alias("_start"),
        F.max(date).alias("_end"),
    ]
    for name, col in SERIOUSNESS_FLAGS:
        if col in cols:
            aggs.append(F.count_if(is_in_set(col, FLAG_VALUES)).alias(f"{name}_count"))
        else:
            aggs.append(F.lit(None).cast("long").alias(f"{name}_count"))
    agg = with_group(cases, by).groupBy(*[_q(k) for k in keys(by)]).agg(*aggs)

    total = F.col("total_unique_cases")
    out = agg.select(
        *[_q(k) for k in keys(by)],
        "total_unique_cases",
        "serious_cases",
        "non_serious_cases",
        "unknown_seriousness",
        percentage("serious_cases", total).alias("serious_percentage"),
        percentage("non_serious_cases", total).alias("non_serious_percentage"),
        "expedite_alert_cases",
        percentage("expedite_alert_cases", total).alias("expedite_alert_percentage"),
        *[
            x
            for name, col in SERIOUSNESS_FLAGS
            for x in (
                F.lit(col in cols).alias(f"{name}_available"),
                F.col(f"{name}_count"),
                F.when(F.lit(col in cols), percentage(f"{name}_count", total))
                .cast("double")
                .alias(f"{name}_percentage"),
            )
        ],
        "age_available_cases",
        "age_missing_cases",
        F.bround("_age_min", 2).alias("age_minimum_years"),
        F.bround("_age_max", 2).alias("age_maximum_years"),
        F.bround("_age_mean", 2).alias("age_mean_years"),
        F.col("age_missing_cases").alias("missing_age"),
        "missing_sex",
        "missing_dates",
        F.col("_start").isNotNull().alias("period_available"),
        _date_text(F.col("_start")).alias("start_date"),
        _date_text(F.col("_end")).alias("end_date"),
        (
            (F.year("_end") * 12 + F.month("_end")) - (F.year("_start") * 12 + F.month("_start")) + 1
        ).cast("long").alias("number_of_months"),
    )
    return out


def case_summary(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A1 (+A2, C16)."""
    return drop_group(
        metrics.select(
            *[_q(k) for k in keys(by)],
            "total_unique_cases",
            "serious_cases",
            "non_serious_cases",
            "unknown_seriousness",
            "serious_percentage",
            "non_serious_percentage",
            "expedite_alert_cases",
            "expedite_alert_percentage",
        ),
        by,
    )


def seriousness_rates(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A3: ``(by..., flag, ord, available, count, percentage)`` — 6 rows per group."""
    entries = [
        F.struct(
            F.lit(name).alias("flag"),
            F.lit(i + 1).alias("ord"),
            F.col(f"{name}_available").alias("available"),
            F.col(f"{name}_count").alias("count"),
            F.col(f"{name}_percentage").alias("percentage"),
        )
        for i, (name, _) in enumerate(SERIOUSNESS_FLAGS)
    ]
    return drop_group(
        metrics.select(*[_q(k) for k in keys(by)], F.inline(F.array(*entries))),
        by,
    )


def alert_rates(metrics: DataFrame, cases_columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., alert, ord, count, percentage, interpretation)``; an
    alert whose column is absent has no row."""
    name_of = {col: name for name, col in SERIOUSNESS_FLAGS}
    entries = []
    for i, (alert, col, text) in enumerate(ALERT_INTERPRETATIONS):
        if col not in cases_columns:
            continue
        count = F.col("expedite_alert_cases") if col == "fulfillexpeditecriteria" else F.col(f"{name_of[col]}_count")
        entries.append(
            F.struct(
                F.lit(alert).alias("alert"),
                F.lit(i + 1).alias("ord"),
                count.alias("count"),
                percentage(count, "total_unique_cases").alias("percentage"),
                F.lit(text).alias("interpretation"),
            )
        )
    if not entries:
        raise ValueError("no alert column present")
    return drop_group(metrics.select(*[_q(k) for k in keys(by)], F.inline(F.array(*entries))), by)


def with_age_median(metrics: DataFrame, cases: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``metrics`` with ``age_median_years`` of the same cases, from counts of
    equal ages (a group without an age has a null)."""
    from casewatch.operators.quantiles import number_counts, quantiles_from_counts

    if "age_years" not in cases.columns:
        return metrics.withColumn("age_median_years", F.lit(None).cast("double"))
    counts = number_counts(cases, "age_years", by)
    median = quantiles_from_counts(counts, {"_median": 0.5}, keys(by)).drop("n")
    # one row of each side per group, put together without a join
    both = metrics.unionByName(median, allowMissingColumns=True).groupBy(*[_q(k) for k in keys(by)])
    held = [c for c in metrics.columns if c not in keys(by)]
    return both.agg(*[F.max(_q(c)).alias(c) for c in held], F.bround(F.max("_median"), 2).alias("age_median_years"))


def age_stats(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A4, over metrics ``with_age_median``."""
    return drop_group(
        metrics.select(
            *[_q(k) for k in keys(by)],
            "age_available_cases",
            "age_missing_cases",
            "age_minimum_years",
            "age_maximum_years",
            "age_mean_years",
            "age_median_years",
        ),
        by,
    )


def reporting_period(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A18."""
    return drop_group(
        metrics.select(
            *[_q(k) for k in keys(by)],
            F.col("period_available").alias("available"),
            "start_date",
            "end_date",
            "number_of_months",
        ),
        by,
    )


def missingness_array(cases_columns: Sequence[str]) -> Column:
    """A17 as an array expression over a ``case_metrics`` row: a sentence per
    missing count > 0 (only for columns present), then the fixed sentences."""
    cols = set(cases_columns)
    computed = []
    if "age_years" in cols:
        computed.append((F.col("missing_age"), MISSING_AGE_NOTE))
    if "patient_patientsex" in cols:
        computed.append((F.col("missing_sex"), MISSING_SEX_NOTE))
    if "report_date" in cols:
        computed.append((F.col("missing_dates"), MISSING_DATE_NOTE))
    variable = (
        F.array(*[F.when(n > 0, F.format_string(t, n)) for n, t in computed])
        if computed
        else F.array().cast("array<string>")
    )
    return F.concat(
        F.filter(variable, lambda x: x.isNotNull()),
        F.array(*[F.lit(s) for s in FIXED_LIMITATIONS]),
    )


def missingness_notes(metrics: DataFrame, cases_columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., ord, note)``."""
    notes = missingness_array(cases_columns)
    return drop_group(
        metrics.select(*[_q(k) for k in keys(by)], F.posexplode(notes).alias("ord", "note")).withColumn(
            "ord", F.col("ord") + 1
        ),
        by,
    )


# -- distributions -------------------------------------------------------------

def unknown_if_blank(c: str | Column) -> Column:
    """A5 value normalization: null/blank -> 'unknown', else stripped."""
    col = _q(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(strip(col.cast("string")), F.lit("")), F.lit(UNKNOWN_VALUE))


def value_counts(
    df: DataFrame,
    dimensions: Sequence[tuple[str, str]],
    by: Sequence[str] = (),
    top_n: int | None = None,
) -> DataFrame:
    """``(by..., dimension, value, n)`` for every
    ``(dimension name, column)`` pair — one unpivot, one shuffle. With
    ``top_n`` also ``rank`` (count desc, then value asc), cut to the first
    ``top_n`` by a partial group limit; without it no task ever sorts all
    values of a dimension."""
    ks = keys(by)
    base = with_group(df, by)
    entries = F.array(
        *[F.struct(F.lit(name).alias("dimension"), unknown_if_blank(col).alias("value")) for name, col in dimensions]
    )
    long = base.select(*[_q(k) for k in ks], F.inline(entries))
    counts = long.groupBy(*[_q(k) for k in ks], "dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    if top_n is None:
        return drop_group(counts, by)
    w = Window.partitionBy(*[_q(k) for k in ks], "dimension").orderBy(F.desc("n"), F.asc("value"))
    return drop_group(counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n), by)


def top_terms(
    reactions: DataFrame,
    by: Sequence[str] = (),
    n: int = TOP_N,
    term_col: str = "reaction_pt",
    serious_only: bool = False,
    serious_col: str = "case_serious",
) -> DataFrame:
    """Top-n reaction terms ``(by..., reaction_pt, n, rank)``.
    ``serious_only`` keeps rows whose case flag is in the reaction-serious
    set; a missing flag column yields no rows."""
    df = reactions.filter(_q(term_col).isNotNull() & (_q(term_col) != ""))
    if serious_only:
        if serious_col not in df.columns:
            df = df.filter(F.lit(False))
        else:
            df = df.filter(is_in_set(serious_col, REACTION_SERIOUS_VALUES))
    ks = keys(by)
    counts = with_group(df, by).groupBy(*[_q(k) for k in ks], _q(term_col).alias("reaction_pt")).agg(
        F.count(F.lit(1)).alias("n")
    )
    w = Window.partitionBy(*[_q(k) for k in ks]).orderBy(F.desc("n"), F.asc("reaction_pt"))
    return drop_group(counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n), by)


def reaction_totals(reactions: DataFrame, by: Sequence[str] = (), term_col: str = "reaction_pt") -> DataFrame:
    """Non-blank reaction rows and distinct (case-sensitive) terms."""
    df = reactions.filter(_q(term_col).isNotNull() & (_q(term_col) != ""))
    ks = keys(by)
    return drop_group(
        with_group(df, by)
        .groupBy(*[_q(k) for k in ks])
        .agg(
            F.count(F.lit(1)).alias("total_reaction_occurrences"),
            F.count_distinct(_q(term_col)).alias("unique_reaction_terms"),
        ),
        by,
    )


# -- months and trends ---------------------------------------------------------

def cases_by_month(cases: DataFrame, by: Sequence[str] = (), date_col: str = "report_date") -> DataFrame:
    """A10: ``(by..., month, n)`` for valid dates; gaps are not filled."""
    ks = keys(by)
    df = with_group(cases, by).filter(_q(date_col).isNotNull())
    return drop_group(
        df.groupBy(*[_q(k) for k in ks], month_of(_q(date_col)).alias("month")).agg(F.count(F.lit(1)).alias("n")),
        by,
    )


def reactions_by_month(reactions: DataFrame, by: Sequence[str] = (), date_col: str = "case_report_date") -> DataFrame:
    """A11 (+D12): reactions whose case has a valid date, per month.

    The case date is carried into each reaction row when un-nesting, which
    replaces the reference's left join + null filter without a shuffle."""
    return cases_by_month(reactions, by, date_col)


def trend_summary(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A12 on ``(by..., month, n)``: first, last, highest (ties -> earliest),
    lowest (ties -> earliest), absolute and percentage change."""
    ks = keys(by)
    m = with_group(monthly, by)
    month = F.col("month")
    month_ordinal = F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int")
    item = F.struct(month.alias("month"), F.col("n").alias("count"))
    agg = m.groupBy(*[_q(k) for k in ks]).agg(
        F.min_by(item, month).alias("first_month"),
        F.max_by(item, month).alias("last_month"),
        # highest count; among ties the earliest month
        F.max_by(item, F.struct(F.col("n"), -month_ordinal)).alias("highest_month"),
        F.min_by(item, F.struct(F.col("n"), month)).alias("lowest_month"),
    )
    change = F.col("last_month.count") - F.col("first_month.count")
    return drop_group(
        agg.select(
            *[_q(k) for k in ks],
            "highest_month",
            "lowest_month",
            "first_month",
            "last_month",
            change.cast("long").alias("absolute_change"),
            F.when(F.col("first_month.count") == 0, F.lit(None).cast("double"))
            .otherwise(percentage(change, F.col("first_month.count")))
            .alias("percentage_change"),
        ),
        by,
    )


def flatten_trend(trend: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trend summary as flat columns (for tables and SQL comparison)."""
    cols = []
    for k in ("highest_month", "lowest_month", "first_month", "last_month"):
        cols += [F.col(f"{k}.month").alias(k), F.col(f"{k}.count").alias(f"{k}_count")]
    return trend.select(*[_q(b) for b in by], *cols, "absolute_change", "percentage_change")


# -- reaction-level -----------------------------------------------------------

def reaction_concentration(
    reactions: DataFrame,
    by: Sequence[str] = (),
    k: int = TOP_K_CONCENTRATION,
    term_col: str = "reaction_pt",
    date_col: str = "case_report_date",
) -> DataFrame:
    """Top-k terms with count and share of ALL reaction rows (null terms
    stay in the denominator). Groups without any dated reaction get no rows.

    Plan: one aggregate on (group, term); its rows are summed to the group
    totals (the same exchange, reused) and ranked with ``row_number() <= k``
    (count desc, term asc), a partial group limit before the exchange, so a
    group with millions of terms never lands whole in one task. The total row
    joins the at most k terms of its group in a second, small window."""
    ks = keys(by)
    base = with_group(reactions, by)
    counts = base.groupBy(*[_q(c) for c in ks], _q(term_col).alias("reaction_pt")).agg(
        F.count(F.lit(1)).alias("count"), F.count_if(_q(date_col).isNotNull()).alias("_dated")
    )
    totals = counts.groupBy(*[_q(c) for c in ks]).agg(F.sum("count").alias("count"), F.sum("_dated").alias("_dated"))
    totals = totals.withColumn("reaction_pt", F.lit(None).cast("string")).withColumn("rank", F.lit(0))
    w = Window.partitionBy(*[_q(c) for c in ks]).orderBy(
        F.col("reaction_pt").isNull(), F.desc("count"), F.asc("reaction_pt")
    )
    head = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    whole = Window.partitionBy(*[_q(c) for c in ks])  # at most k + 1 rows
    carried = head.unionByName(totals).select(
        "*",
        F.max(F.when(F.col("rank") == 0, F.col("count"))).over(whole).alias("_total"),
        F.max(F.when(F.col("rank") == 0, F.col("_dated"))).over(whole).alias("_dated_all"),
    )
    top = carried.filter((F.col("rank") > 0) & F.col("reaction_pt").isNotNull() & (F.col("_dated_all") > 0))
    return drop_group(
        top.select(
            *[_q(c) for c in ks],
            "reaction_pt",
            "rank",
            "count",
            percentage("count", "_total").alias("percentage_of_reactions"),
        ),
        by,
    )


def reaction_month_matrix(
    reactions: DataFrame,
    by: Sequence[str] = (),
    k: int = TOP_K_CONCENTRATION,
    term_col: str = "reaction_pt",
    date_col: str = "case_report_date",
) -> DataFrame:
    """For the top-k terms of each group, counts per month
    ``(by..., reaction_pt, rank, month, n)``.

    One aggregate on (group, term, month), then one on (group, term) that
    sums the term total and keeps the term's month cells (bounded by the
    months of the period). Terms are ranked with ``row_number() <= k``
    (partial WindowGroupLimit before the exchange) and the kept terms'
    month cells are un-nested in the row: no join back, one pass."""
    ks = keys(by)
    base = with_group(reactions, by).filter(_q(term_col).isNotNull())
    cells = base.groupBy(
        *[_q(c) for c in ks],
        _q(term_col).alias("reaction_pt"),
        F.when(_q(date_col).isNotNull(), month_of(_q(date_col))).alias("month"),
    ).agg(F.count(F.lit(1)).alias("n"))
    per_term = cells.groupBy(*[_q(c) for c in ks], "reaction_pt").agg(
        F.sum("n").alias("_t"),
        F.collect_list(F.when(F.col("month").isNotNull(), F.struct("month", "n"))).alias("_cells"),
    )
    w = Window.partitionBy(*[_q(c) for c in ks]).orderBy(F.desc("_t"), F.asc("reaction_pt"))
    top = per_term.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    out = top.select(*[_q(c) for c in ks], "reaction_pt", "rank", F.inline("_cells"))
    return drop_group(out.select(*[_q(c) for c in ks], "reaction_pt", "rank", "month", "n"), by)
