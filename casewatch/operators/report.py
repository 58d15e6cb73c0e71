"""Report table and document (G1-G6): one Markdown document per group, each
section a column expression over the group's evidence row and its five
section records. No driver loop; the document is assembled per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from casewatch.config import (
    CASE_SENTENCE,
    DEFAULT_MODEL_NAME,
    METHODOLOGY_TEXT,
    NAMED_LIMITATIONS_INTRO,
    NO_LIMITATIONS_TEXT,
    ONLY_NULL_LIMITATIONS_TEXT,
    PERIOD_SENTENCE,
    PERIOD_UNAVAILABLE,
    REPORT_HEADINGS,
    REPORT_TITLE,
    REVIEW_CHECKLIST,
    REVIEW_LIST_INTRO,
    REVIEW_PASSED,
    REVIEW_PENDING,
    TRACEABILITY_TEXT,
)
from casewatch.functions.joins import join_null_safe
from casewatch.operators.sections import SECTIONS, group_keys, with_group


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def period_sentence(ev: Column) -> Column:
    """G1."""
    rp = ev["reporting_period"]
    available = F.coalesce(rp["available"], F.lit(False)) | rp["start_date"].isNotNull()
    return F.when(~available, F.lit(PERIOD_UNAVAILABLE)).otherwise(
        F.format_string(
            PERIOD_SENTENCE,
            F.coalesce(rp["start_date"], F.lit("None")),
            F.coalesce(rp["end_date"], F.lit("None")),
            F.coalesce(rp["number_of_months"].cast("string"), F.lit("None")),
        )
    )


def case_sentence(ev: Column) -> Column:
    """Counts with thousands separators."""
    cs = ev["case_summary"]
    return F.format_string(
        CASE_SENTENCE,
        *[
            F.format_string("%,d", cs[k])
            for k in ("total_unique_cases", "serious_cases", "non_serious_cases", "expedite_alert_cases")
        ],
    )


def methodology(model_name: str = DEFAULT_MODEL_NAME) -> Column:
    """G3."""
    return F.lit(METHODOLOGY_TEXT % model_name)


def _listed(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def limitations_text(ev: Column) -> Column:
    """``- item`` lines, or the fixed sentence when there are none."""
    items = F.coalesce(ev["limitations"], F.array().cast("array<string>"))
    return F.when(F.size(items) == 0, F.lit(NO_LIMITATIONS_TEXT)).otherwise(_listed(items))


def _as_text(v: Column) -> Column:
    """A JSON value as a sentence shows it: None, True and False, else its own text."""
    kind = F.schema_of_variant(v)
    text = F.when(kind == "BOOLEAN", F.initcap(v.cast("string"))).otherwise(v.cast("string"))
    return F.when(F.is_variant_null(v) | v.isNull(), F.lit("None")).otherwise(text)


def limitations_text_json(limits: Column) -> Column:
    """G4 for documents from outside, where the limitations are JSON text: a
    list gives ``- item`` lines; an object gives ``- name: value`` lines in its
    own order, one line per item of a list and none for null, under a sentence of
    introduction; an empty or missing value, ``0``, ``false`` and ``""`` give the
    fixed sentence. An object or list inside an item stays JSON."""
    text = F.trim(F.coalesce(limits, F.lit("")))
    items = F.transform(F.from_json(text, "array<variant>"), _as_text)

    def lines(e: Column) -> Column:
        named = lambda v: F.concat(e["key"], F.lit(": "), _as_text(v))
        several = F.schema_of_variant(e["value"]).startswith("ARRAY")
        one_or_more = F.when(several, F.transform(e["value"].cast("array<variant>"), named)).otherwise(F.array(named(e["value"])))
        return F.when(F.is_variant_null(e["value"]) | e["value"].isNull(), F.array().cast("array<string>")).otherwise(one_or_more)

    entries = F.map_entries(F.from_json(text, "map<string,variant>"))
    found = F.flatten(F.transform(entries, lines))
    empty = text.isin("", "null", "0", "false", '""') | text.rlike(r"^(\[\s*\]|\{\s*\})$")
    named = F.when(F.size(found) == 0, F.lit(ONLY_NULL_LIMITATIONS_TEXT)).otherwise(
        F.concat(F.lit(NAMED_LIMITATIONS_INTRO + "\n\n"), _listed(found))
    )
    return F.when(empty, F.lit(NO_LIMITATIONS_TEXT)).when(text.startswith("{"), named).otherwise(_listed(items))


def _limitations(struct_df: DataFrame) -> Column:
    """The limitations of an evidence table, whose field is a list or JSON text."""
    ev = F.col("evidence")
    held = struct_df.schema["evidence"].dataType["limitations"].dataType
    return limitations_text_json(ev["limitations"]) if isinstance(held, StringType) else limitations_text(ev)


def review_status(failing: Column) -> Column:
    """G5 from the ordered list of sections that need review."""
    listed = F.array_join(F.transform(failing, lambda x: F.concat(F.lit("- "), x)), "\n")
    return F.when(
        F.size(failing) > 0,
        F.concat(F.lit(REVIEW_PENDING + "\n\n" + REVIEW_LIST_INTRO + "\n\n"), listed),
    ).otherwise(F.lit(REVIEW_PENDING + "\n\n" + REVIEW_PASSED))


def report_sections(struct_df: DataFrame, by: Sequence[str], model_name: str = DEFAULT_MODEL_NAME) -> DataFrame:
    """Deterministic report sections computed from the evidence alone
    (1 period, 3 case summary, 8 methodology, 9 limitations, 11 traceability):
    ``(group..., section_no, title, body)``."""
    ev = F.col("evidence")
    rows = F.array(
        *[
            F.struct(F.lit(no).alias("section_no"), F.lit(REPORT_HEADINGS[no - 1].split(". ", 1)[1]).alias("title"),
                     body.alias("body"))
            for no, body in (
                (1, period_sentence(ev)),
                (3, case_sentence(ev)),
                (8, methodology(model_name)),
                (9, _limitations(struct_df)),
                (11, F.lit(TRACEABILITY_TEXT)),
            )
        ]
    )
    return struct_df.select(*[_q(k) for k in by], F.inline(rows))


def report_document(
    struct_df: DataFrame,
    validated: DataFrame,
    by: Sequence[str],
    model_name: str = DEFAULT_MODEL_NAME,
) -> DataFrame:
    """``(group..., report)`` — the 11-section Markdown document.

    The five section texts and the review list are pivoted per group with
    one aggregate (five known section names, so the pivot is bounded)."""
    keep = list(by)
    struct_df = with_group(struct_df, by)
    validated = with_group(validated, by)
    by = group_keys(by)
    texts = validated.groupBy(*[_q(k) for k in by]).agg(
        *[F.max(F.when(F.col("report_section") == s, F.col("text"))).alias(f"t_{s}") for s in SECTIONS],
        F.array_sort(
            F.collect_list(F.when(F.col("human_review_required"), F.struct("section_ord", "report_section")))
        ).alias("_failing"),
    )
    df = join_null_safe(struct_df, texts, list(by))
    ev = F.col("evidence")
    failing = F.transform(F.coalesce("_failing", F.array()), lambda x: x["report_section"])
    bodies = [
        period_sentence(ev),
        F.col("t_narrative_summary"),
        case_sentence(ev),
        F.col("t_summary_analysis"),
        F.col("t_reaction_analysis"),
        F.col("t_serious_alert_analysis"),
        F.col("t_trend_interpretation"),
        methodology(model_name),
        _limitations(struct_df),
        F.concat(review_status(failing), F.lit("\n\n" + REVIEW_CHECKLIST)),
        F.lit(TRACEABILITY_TEXT),
    ]
    parts: list[Column] = [F.lit(REPORT_TITLE + "\n\n")]
    for i, (heading, body) in enumerate(zip(REPORT_HEADINGS, bodies)):
        parts.append(F.lit(f"## {heading}\n\n"))
        parts.append(F.coalesce(body, F.lit("")))
        if i < len(REPORT_HEADINGS) - 1:
            parts.append(F.lit("\n\n---\n\n"))
    return df.select(*[_q(k) for k in keep], F.trim(F.concat(*parts)).alias("report"))
