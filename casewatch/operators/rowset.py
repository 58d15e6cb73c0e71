"""Row-set operators (D1-D12): newest version, target filter, un-nesting,
distinct, counters.

Shuffle budget: exactly one exchange, on the case key, for D1. It is an
aggregate (``max`` of a struct) rather than a window, so partial aggregation collapses
a hot key map-side before the exchange. Un-nesting and distinct happen
inside each parent row (no shuffle): ids are unique after D1, so equal child
rows always share one parent and an in-row ``array_distinct`` equals a
global ``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from casewatch.config import (
    DEFAULT_TARGET_PATTERN,
    NULL_SENTINELS,
    OPTIONAL_DRUG_FIELDS,
    REACTION_CASE_FLAGS,
)
from casewatch.functions import split_packed


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# -- D1 ---------------------------------------------------------------------

def latest_version(
    df: DataFrame,
    key: str = "safetyreportid",
    version: str = "safetyreportversion",
    tiebreak: Sequence[str] | None = None,
    rows_col: str | None = None,
) -> DataFrame:
    """Newest row per key: highest ``version``, ties broken by ``tiebreak``
    (descending; default: every other column). Null keys form one group.

    Plan: partial ``max`` of one struct -> Exchange(key) -> final ``max`` (a
    sort-based aggregate, since the buffer is a struct). Rows equal in version
    and ``tiebreak`` are decided by the remaining columns. The partial step leaves one row
    per key and map partition, so a key holding a third of all rows is
    reduced before the shuffle instead of landing whole in one task.
    ``rows_col`` adds the number of rows that each key had.
    """
    others = [c for c in df.columns if c != key]
    tb = list(tiebreak) if tiebreak is not None else []
    # version, tiebreak columns, then the rest: each column is carried once
    order = [version, *tb, *[c for c in others if c != version and c not in tb]]
    newest = F.max(F.struct(*[_q(c) for c in order])).alias("_newest")
    counted = [F.count(F.lit(1)).alias(rows_col)] if rows_col else []
    picked = df.groupBy(_q(key)).agg(newest, *counted)
    return picked.select(_q(key), *[F.col(f"_newest.`{c}`").alias(c) for c in others], *([rows_col] if rows_col else []))


# -- D2 / D3 ----------------------------------------------------------------

def target_match(c: str | Column, pattern: str = DEFAULT_TARGET_PATTERN) -> Column:
    """Upper-cased value searched by ``pattern``; null -> false."""
    col = _q(c) if isinstance(c, str) else c
    return F.coalesce(F.upper(col).rlike("(?U)" + pattern), F.lit(False))


def filter_to_target(
    df: DataFrame,
    column: str = "patient_drug_activesubstance_activesubstancename",
    pattern: str = DEFAULT_TARGET_PATTERN,
    enabled: bool = True,
) -> DataFrame:
    """D3: keep rows whose column matches the target pattern (if enabled)."""
    return df.filter(target_match(column, pattern)) if enabled else df


def semi_join_valid(child: DataFrame, retained: DataFrame, key: str = "safetyreportid") -> DataFrame:
    """Child rows whose key is in the retained key set (null-safe).

    Left-semi join: the retained side is projected to the key only, and AQE
    picks broadcast or sort-merge from its runtime size.
    """
    keys = retained.select(_q(key).alias("_k"))
    return child.join(keys, child[key].eqNullSafe(keys["_k"]), "left_semi")


# -- D5-D10: un-nesting -----------------------------------------------------

def _items(df: DataFrame, c: str) -> Column:
    """D5 on a packed text column or on a real list column."""
    return split_packed(_q(c), isinstance(df.schema[c].dataType, ArrayType))


def _sentinel_null(c: Column, sentinels: Sequence[str]) -> Column:
    c = F.nullif(c, F.lit(""))
    if sentinels:
        c = F.when(c.isin(list(sentinels)), F.lit(None).cast("string")).otherwise(c)
    return c


def explode_reactions(
    latest: DataFrame,
    key: str = "safetyreportid",
    term_col: str = "patient_reaction_reactionmeddrapt",
    outcome_col: str = "patient_reaction_reactionoutcome",
    version_col: str = "patient_reaction_reactionmeddraversionpt",
    carry: Sequence[str] = (),
    null_sentinels: Sequence[str] = NULL_SENTINELS,
) -> DataFrame:
    """D5-D7 + D9 + D10: one row per (case, reaction).

    Lists are zipped by position over the reaction list's length (shorter
    lists pad with null), empty terms are skipped, outcome is lower-cased,
    duplicate rows are removed inside the parent row, then empty text
    becomes null (the reference's CSV round trip).
    ``carry`` adds parent columns (group keys, parsed report date).
    """
    cols = set(latest.columns)
    ver = _items(latest, version_col) if version_col in cols else F.array().cast("array<string>")
    flags = [(src, dst) for src, dst in REACTION_CASE_FLAGS if src in cols]
    base = latest.select(
        _q(key).alias(key),
        *[_q(c) for c in carry],
        *[_q(src).alias(dst) for src, dst in flags],
        _items(latest, term_col).alias("_rx"),
        _items(latest, outcome_col).alias("_out"),
        ver.alias("_ver"),
    )
    items = F.slice(F.arrays_zip("_rx", "_out", "_ver"), 1, F.size("_rx"))
    items = F.transform(
        items,
        lambda x: F.struct(
            x["_rx"].alias("reaction_pt"),  # items are stripped already
            F.lower(x["_out"]).alias("reaction_outcome"),
            x["_ver"].alias("meddra_version"),
        ),
    )
    items = F.array_distinct(F.filter(items, lambda x: x["reaction_pt"] != ""))
    rows = base.select(
        key, *carry, *[dst for _, dst in flags], F.inline(items)
    )
    return rows.select(
        key,
        _sentinel_null(F.col("reaction_pt"), null_sentinels).alias("reaction_pt"),
        _sentinel_null(F.col("reaction_outcome"), null_sentinels).alias("reaction_outcome"),
        _sentinel_null(F.col("meddra_version"), null_sentinels).alias("meddra_version"),
        *[_q(dst) for _, dst in flags],
        *[_q(c) for c in carry],
    )


def explode_drugs(
    latest: DataFrame,
    key: str = "safetyreportid",
    characterization_col: str = "patient_drug_drugcharacterization",
    product_col: str = "patient_drug_medicinalproduct",
    substance_col: str = "patient_drug_activesubstance_activesubstancename",
    pattern: str = DEFAULT_TARGET_PATTERN,
    carry: Sequence[str] = (),
    null_sentinels: Sequence[str] = NULL_SENTINELS,
) -> DataFrame:
    """D8 + D9 + D10: one row per (case, matching drug item).

    Items whose substance matches the target pattern are kept even when the
    case filter is off. Zipping pads to the longest list; items past the
    substance list have a null substance and never match.
    """
    cols = set(latest.columns)
    optional = [(src, dst) for src, dst in OPTIONAL_DRUG_FIELDS if src in cols]
    lists = [
        ("drug_characterization", characterization_col),
        ("medicinal_product", product_col),
        ("active_substance", substance_col),
    ] + [(dst, src) for src, dst in optional]
    base = latest.select(
        _q(key).alias(key),
        *[_q(c) for c in carry],
        *[_items(latest, src).alias(f"_{dst}") for dst, src in lists],
    )
    zipped = F.arrays_zip(*[f"_{dst}" for dst, _ in lists])
    lowered = {"drug_characterization", "route", "action_taken"}

    def norm(dst: str, v: Column) -> Column:
        if dst == "active_substance":
            return F.upper(v)
        if dst in lowered:
            return F.lower(v)
        return v  # items are stripped already

    items = F.filter(zipped, lambda x: target_match(x["_active_substance"], pattern))
    items = F.array_distinct(
        F.transform(items, lambda x: F.struct(*[norm(dst, x[f"_{dst}"]).alias(dst) for dst, _ in lists]))
    )
    rows = base.select(key, *carry, F.inline(items))
    return rows.select(
        key,
        *[_sentinel_null(F.col(dst), null_sentinels).alias(dst) for dst, _ in lists],
        *[_q(c) for c in carry],
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """D10 for tables that are not un-nested in-row: full-row distinct
    (null equals null, '' differs from null). One shuffle on all columns,
    with map-side partial dedupe."""
    return df.dropDuplicates()


# -- D11 --------------------------------------------------------------------

def pipeline_counters(
    raw: DataFrame,
    latest: DataFrame,
    retained: DataFrame,
    reactions: DataFrame,
    drugs: DataFrame,
    key: str = "safetyreportid",
    substance_col: str = "patient_drug_activesubstance_activesubstancename",
    pattern: str = DEFAULT_TARGET_PATTERN,
    by: Sequence[str] = (),
) -> DataFrame:
    """Run counters as a long table ``(by..., counter, value)``.

    Each counter is one partial+final aggregate; they are unioned (no cross
    join). ``unique_ids`` counts non-null keys of ``latest`` (one row per key
    already), so no extra distinct shuffle is needed.
    """
    g = [_q(c) for c in by]

    def long(df: DataFrame, pairs: list[tuple[str, Column]]) -> DataFrame:
        agg = df.groupBy(*g).agg(*[e.cast("long").alias(n) for n, e in pairs])
        stack = F.expr(
            "stack({}, {})".format(len(pairs), ", ".join(f"'{n}', `{n}`" for n, _ in pairs))
        ).alias("counter", "value")
        return agg.select(*g, stack)

    match = target_match(substance_col, pattern)
    parts = [
        long(raw, [("raw_rows", F.count(F.lit(1)))]),
        long(
            latest,
            [
                ("unique_ids", F.count(_q(key))),
                ("cases_with_target", F.count_if(match)),
                ("cases_without_target", F.count(F.lit(1)) - F.count_if(match)),
            ],
        ),
        long(retained, [("cases_retained", F.count(F.lit(1)))]),
        long(reactions, [("reaction_records", F.count(F.lit(1)))]),
        long(drugs, [("target_drug_rows", F.count(F.lit(1)))]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def attach_case_dates(
    reactions: DataFrame,
    cases: DataFrame,
    key: str = "safetyreportid",
    date_col: str = "report_date",
    out_col: str = "case_report_date",
) -> DataFrame:
    """D12 for reaction tables that arrive without their case date: left
    equi-join on the key (null keys match, as in the reference), keeping only
    rows with a date. A plain equi-join: AQE broadcasts the case side only if
    its runtime size is under the threshold, otherwise sort-merge."""
    dates = cases.select(_q(key).alias("_k"), _q(date_col).alias(out_col))
    joined = reactions.join(dates, reactions[key].eqNullSafe(dates["_k"]), "left").drop("_k")
    return joined.filter(F.col(out_col).isNotNull())
