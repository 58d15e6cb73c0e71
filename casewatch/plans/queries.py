"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family of the survey, each over the WHOLE driver tables.

SQL twins with identical column names live in ``casewatch.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.config import RunParams
from casewatch.functions import lower_strip, month_of, parse_date
from casewatch.functions.joins import join_null_safe
from casewatch.operators.counters import RunCounters, row_counts
from casewatch.operators import distinct_terms as H
from casewatch.operators import metrics as M
from casewatch.operators import quantiles as Q
from casewatch.operators.clean import (
    add_age,
    clean_columns,
    coerce_numeric,
    normalize_categoricals,
    prepare_cases,
)
from casewatch.operators.rowset import (
    distinct_rows,
    explode_drugs,
    explode_reactions,
    filter_to_target,
    latest_version,
    semi_join_valid,
)
from casewatch.plans import adapters as A
from casewatch.plans.pipeline import ensure_checkpoint_dir, preprocess, stage
from casewatch.sources.case_store import CaseStore
from casewatch.sources.quarantine import parse_csv, parse_json

Query = Callable[[SparkSession, str], DataFrame]

WIDGET = RunParams(target_pattern=A.TARGET_PATTERN, target_label="Widget")


# -- shared inputs --------------------------------------------------------------

def _cases(spark: SparkSession, sf: str) -> DataFrame:
    """Case table over all orders (ids are unique by construction)."""
    return prepare_cases(coerce_numeric(clean_columns(A.case_reports(spark, sf))))


def _metrics(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    cases = _cases(spark, sf)
    return M.case_metrics(cases), cases.columns


def _reactions(spark: SparkSession, sf: str) -> DataFrame:
    """Reactions un-nested from the packed raw table (all cases)."""
    clean = coerce_numeric(clean_columns(A.raw_reports(spark, sf)))
    dated = clean.withColumn("case_report_date", parse_date("report_date"))
    return explode_reactions(dated, carry=["case_report_date"])


def _date_text(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.date_format(col, "yyyy-MM-dd"))


# -- C: cleaning ----------------------------------------------------------------

def q_clean_columns(spark, sf):
    return normalize_categoricals(clean_columns(A.case_reports(spark, sf)))


def q_numeric_coercion(spark, sf):
    return coerce_numeric(A.id_texts(spark, sf))


def q_parse_report_date(spark, sf):
    df = A.date_texts(spark, sf)
    return df.select("safetyreportid", "date_text", F.date_format(parse_date("date_text"), "yyyy-MM-dd").alias("report_date"))


def q_age_normalize(spark, sf):
    df = add_age(coerce_numeric(clean_columns(A.case_reports(spark, sf))))
    return df.select("safetyreportid", "age", "age_unit", "age_years", "age_group")


def q_key_violations(spark, sf):
    df = coerce_numeric(clean_columns(A.versioned_reports(spark, sf)))
    return df.groupBy("safetyreportid").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


# -- S1: lines into rows and violations --------------------------------------------

def _both_outputs(scan):
    return scan.rows.unionByName(scan.violations, allowMissingColumns=True)


def q_csv_quarantine(spark, sf):
    return _both_outputs(parse_csv(A.csv_lines(spark, sf), required=A.LINE_COLUMNS))


def q_json_quarantine(spark, sf):
    """Twin of the rows only: a cut-off line is compared by its reason."""
    scan = parse_json(A.json_lines(spark, sf), required=A.LINE_COLUMNS[:2], columns=[*A.LINE_COLUMNS, "codes", "nested"])
    counted = scan.violations.groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("n_lines"))
    return scan.rows.unionByName(counted, allowMissingColumns=True)


# -- D: row sets ----------------------------------------------------------------

def q_latest_version(spark, sf):
    df = coerce_numeric(clean_columns(A.versioned_reports(spark, sf)))
    return latest_version(df, tiebreak=["o_orderkey"])


def q_case_store_merge(spark, sf):
    """S2 + D1: two deliveries merged into stored cases, one after the other."""
    df = coerce_numeric(clean_columns(A.versioned_reports(spark, sf)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/case-store-{uuid.uuid4().hex}"
    store = CaseStore(spark, path, df.schema, tiebreak=["o_orderkey"])
    early = F.coalesce(F.col("report_date") < "1996-01-01", F.lit(False))
    store.merge(df.where(early))
    store.merge(df.where(~early))
    return store.cases()


def _retained(spark, sf):
    clean = coerce_numeric(clean_columns(A.raw_reports(spark, sf)))
    return filter_to_target(latest_version(clean), pattern=A.TARGET_PATTERN)


def q_target_regex_filter(spark, sf):
    return _retained(spark, sf).select("safetyreportid", "patient_drug_activesubstance_activesubstancename")


def q_semi_join_valid_cases(spark, sf):
    return semi_join_valid(A.line_reactions(spark, sf), _retained(spark, sf))


def q_reaction_explode(spark, sf):
    return _date_text(_reactions(spark, sf), "case_report_date")


def q_reaction_distinct(spark, sf):
    df = A.line_reactions(spark, sf).select(
        "safetyreportid",
        "reaction_pt",
        lower_strip("reaction_outcome").alias("reaction_outcome"),
        "version_tag",
    )
    return distinct_rows(df).withColumn("reaction_outcome", F.nullif("reaction_outcome", F.lit("")))


def q_drug_explode_filter(spark, sf):
    clean = coerce_numeric(clean_columns(A.raw_reports(spark, sf)))
    return explode_drugs(clean, pattern=A.TARGET_PATTERN)


def q_pipeline_counters(spark, sf):
    counters = RunCounters()  # those of the raw table come from the write of the version pick
    t = preprocess(A.raw_reports(spark, sf), WIDGET, staged=True, counters=counters)
    tables = {"cases_retained": t.retained, "reaction_records": t.reactions, "target_drug_rows": t.drugs}
    return counters.table(spark).unionByName(row_counts(tables))


# -- A: aggregates ----------------------------------------------------------------

def q_case_summary(spark, sf):
    m, _ = _metrics(spark, sf)
    return M.case_summary(m)


def q_seriousness_rates(spark, sf):
    m, _ = _metrics(spark, sf)
    return M.seriousness_rates(m)


def q_age_stats(spark, sf):
    cases = _cases(spark, sf)
    return M.age_stats(M.with_age_median(M.case_metrics(cases), cases))


def _cases_by_country(spark, sf):
    cases = coerce_numeric(clean_columns(A.case_reports(spark, sf)))
    return prepare_cases(cases.withColumn("country", F.col("primarysourcecountry")), ["country"])


def q_age_quantiles(spark, sf):
    """A4 exactly, per country: quartiles from counts of equal ages."""
    out = Q.exact_quantiles(_cases_by_country(spark, sf), "age_years", by=["country"])
    return out.select("country", "n", *[F.bround(q, 2).alias(q) for q in Q.QUARTILES])


def q_age_sketch_quantiles(spark, sf):
    """A4 from stored sketches per (country, month), merged per country: their
    exact n, and whether each quartile keeps to the bound of the rank error."""
    cases = _cases_by_country(spark, sf).withColumn("month", month_of("report_date"))
    stored = stage(Q.number_sketches(cases, "age_years", ["country", "month"]))
    merged = Q.sketch_quantiles(Q.merge_sketches(stored, ["country"]), by=["country"])
    errors = Q.rank_errors(merged, Q.number_counts(cases, "age_years", ["country"]), Q.QUARTILES, ["country"])
    both = join_null_safe(merged.select("country", "n"), errors, ["country"], "inner")
    return both.select("country", "n", *[(F.col(f"{q}_error") <= Q.RANK_ERROR).alias(f"{q}_kept") for q in Q.QUARTILES])


DIST_DIMENSIONS = (
    ("age_group_distribution", "age_group"),
    ("sex_distribution", "patient_patientsex"),
    ("primary_source_country", "primarysourcecountry"),
    ("occurrence_country", "occurcountry"),
)
COUNTRY_DIMENSIONS = DIST_DIMENSIONS[2:]


def q_category_distribution(spark, sf):
    return M.value_counts(_cases(spark, sf), DIST_DIMENSIONS)


def q_country_top10(spark, sf):
    return M.value_counts(_cases(spark, sf), COUNTRY_DIMENSIONS, top_n=10)


def q_reaction_totals(spark, sf):
    return M.reaction_totals(_reactions(spark, sf))


def _reactions_by_country(spark, sf):
    """Reactions un-nested with the reporting country of their case."""
    raw = A.raw_reports(spark, sf).withColumn("country", F.col("primarysourcecountry"))
    clean = coerce_numeric(clean_columns(raw))
    return explode_reactions(clean.withColumn("case_report_date", parse_date("report_date")), carry=["country", "case_report_date"])


def q_reaction_term_sketches(spark, sf):
    """A7 from stored sketches per (country, month), united per country and over
    all: exact occurrences, exact distinct terms, and whether the estimate keeps
    to its bound. The country of the row over all is ``*``. The reactions are
    stored once, as the sketches and both exact counts read them."""
    reactions = stage(_reactions_by_country(spark, sf).select("country", "case_report_date", "reaction_pt"))
    stored = stage(H.term_sketches(reactions, ["country"]))
    every = F.lit("*").alias("country")
    found = H.estimated_terms(H.unite_terms(stored, ["country"]), ["country"]).unionByName(
        H.estimated_terms(H.unite_terms(stored)).select(every, "total_reaction_occurrences", "unique_reaction_terms")
    )
    exact = M.reaction_totals(reactions, ["country"]).unionByName(M.reaction_totals(reactions).select(every, "*"))
    exact = exact.select("country", F.col("unique_reaction_terms").alias("exact_terms"))
    both = join_null_safe(found, exact, ["country"], "inner")
    off = F.abs(F.col("unique_reaction_terms") - F.col("exact_terms"))
    return both.select(
        "country", "total_reaction_occurrences", "exact_terms", (off <= F.col("exact_terms") * H.RELATIVE_ERROR + 1).alias("kept")
    )


def q_top_reactions(spark, sf):
    return M.top_terms(_reactions(spark, sf))


def q_top_serious_reactions(spark, sf):
    return M.top_terms(_reactions(spark, sf), serious_only=True)


def q_cases_by_month(spark, sf):
    return M.cases_by_month(_cases(spark, sf))


def q_reactions_by_month(spark, sf):
    return M.reactions_by_month(_reactions(spark, sf))


def q_case_trend_summary(spark, sf):
    return M.flatten_trend(M.trend_summary(M.cases_by_month(_cases(spark, sf))))


def q_outcome_distribution(spark, sf):
    return M.value_counts(_reactions(spark, sf), [("reaction_outcome_distribution", "reaction_outcome")]).drop(
        "dimension"
    )


def q_alert_rates(spark, sf):
    m, cols = _metrics(spark, sf)
    return M.alert_rates(m, cols)


def q_reaction_concentration(spark, sf):
    return M.reaction_concentration(_reactions(spark, sf))


def q_reaction_month_matrix(spark, sf):
    return M.reaction_month_matrix(_reactions(spark, sf))


def q_missingness_notes(spark, sf):
    m, cols = _metrics(spark, sf)
    return M.missingness_notes(m, cols)


def q_reporting_period(spark, sf):
    m, _ = _metrics(spark, sf)
    return M.reporting_period(m)


QUERIES: dict[str, Query] = {
    "clean_columns": q_clean_columns,
    "numeric_coercion": q_numeric_coercion,
    "parse_report_date": q_parse_report_date,
    "age_normalize": q_age_normalize,
    "key_violations": q_key_violations,
    "csv_quarantine": q_csv_quarantine,
    "json_quarantine": q_json_quarantine,
    "latest_version": q_latest_version,
    "case_store_merge": q_case_store_merge,
    "target_regex_filter": q_target_regex_filter,
    "semi_join_valid_cases": q_semi_join_valid_cases,
    "reaction_explode": q_reaction_explode,
    "reaction_distinct": q_reaction_distinct,
    "drug_explode_filter": q_drug_explode_filter,
    "pipeline_counters": q_pipeline_counters,
    "case_summary": q_case_summary,
    "seriousness_rates": q_seriousness_rates,
    "age_stats": q_age_stats,
    "age_quantiles": q_age_quantiles,
    "age_sketch_quantiles": q_age_sketch_quantiles,
    "category_distribution": q_category_distribution,
    "country_top10": q_country_top10,
    "reaction_totals": q_reaction_totals,
    "reaction_term_sketches": q_reaction_term_sketches,
    "top_reactions": q_top_reactions,
    "top_serious_reactions": q_top_serious_reactions,
    "cases_by_month": q_cases_by_month,
    "reactions_by_month": q_reactions_by_month,
    "case_trend_summary": q_case_trend_summary,
    "outcome_distribution": q_outcome_distribution,
    "alert_rates": q_alert_rates,
    "reaction_concentration": q_reaction_concentration,
    "reaction_month_matrix": q_reaction_month_matrix,
    "missingness_notes": q_missingness_notes,
    "reporting_period": q_reporting_period,
}


# -- F: grounding checks over text ---------------------------------------------

from casewatch.config import FLAGGED_PHRASES, WHOLE_NUMBER_PATTERN  # noqa: E402
from casewatch.operators import grounding as G  # noqa: E402

# The fixed phrase list plus licence phrases that do occur in the documents.
CHECK_PHRASES = FLAGGED_PHRASES + ("license", "licensed", "all rights reserved", "apache", "mit")


def _documents(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", "lang", "text")


def _page_evidence(spark, sf):
    """Evidence texts: every page, grouped by the language of its html tag."""
    pages = A.table(spark, sf, "pages")
    return pages.select(F.regexp_extract("html", r'<html lang="([A-Za-z-]+)"', 1).alias("lang"), "html")


def _doc_numbers(spark, sf):
    return G.text_numbers(_documents(spark, sf), ["doc_id", "lang"])


def _doc_unsupported(spark, sf):
    evidence = G.evidence_numbers_from_text(_page_evidence(spark, sf), ["lang"], "html")
    return G.unsupported_numbers(_doc_numbers(spark, sf), evidence, ["lang"])


def q_text_numbers(spark, sf):
    return _doc_numbers(spark, sf)


def q_text_numbers_whole(spark, sf):
    return G.text_numbers(_documents(spark, sf), ["doc_id", "lang"], pattern=WHOLE_NUMBER_PATTERN)


def q_evidence_numbers(spark, sf):
    return G.evidence_numbers_from_text(_page_evidence(spark, sf), ["lang"], "html")


def q_unsupported_numbers(spark, sf):
    return _doc_unsupported(spark, sf)


def q_claim_phrases(spark, sf):
    return G.claim_findings(_documents(spark, sf), ["doc_id"], phrases=CHECK_PHRASES)


def q_section_validation(spark, sf):
    evidence = G.evidence_numbers_from_text(_page_evidence(spark, sf), ["lang"], "html")
    return G.section_validation(_documents(spark, sf), ["doc_id"], ["lang"], evidence, phrases=CHECK_PHRASES)


QUERIES.update(
    {
        "text_numbers": q_text_numbers,
        "text_numbers_whole": q_text_numbers_whole,
        "evidence_numbers": q_evidence_numbers,
        "unsupported_numbers": q_unsupported_numbers,
        "claim_phrases": q_claim_phrases,
        "section_validation": q_section_validation,
    }
)


# -- A19 / E: evidence document, sections, prompts -------------------------------

from casewatch.operators import documents as D  # noqa: E402
from casewatch.operators import evidence as EV  # noqa: E402

GROUP_BY = ["country"]


def _evidence_tables(spark, sf, nullable=False):
    """End-to-end preprocessing with the target filter on, grouped by the
    reporting country (one evidence document and report per country).
    ``nullable``: the country of report type P is null on purpose."""
    country = F.col("primarysourcecountry")
    if nullable:
        country = F.when(F.col("reporttype") != "P", country)
    raw = A.raw_reports(spark, sf).withColumn("country", country)
    return preprocess(raw, WIDGET, by=GROUP_BY, staged=True)


def _evidence(spark, sf, nullable=False):
    """Per-country evidence documents, materialized once (one row per group)
    because facts, JSON, sections, prompts and the report all read them."""
    return stage(EV.evidence_struct(EV.evidence_parts(_evidence_tables(spark, sf, nullable), WIDGET)))


def q_evidence_facts(spark, sf):
    return EV.evidence_facts(_evidence(spark, sf), GROUP_BY)


def q_evidence_json(spark, sf):
    return EV.evidence_json(_evidence(spark, sf), GROUP_BY)


def q_document_numbers(spark, sf):
    """F3 on evidence documents read as text, their shape unknown."""
    docs = EV.evidence_json(_evidence(spark, sf), GROUP_BY)
    leaves, _ = D.document_leaves(docs, GROUP_BY, "evidence_json")
    return G.evidence_numbers_from_facts(leaves, GROUP_BY)


def q_document_leaves(spark, sf):
    """Leaves and violations of order documents of four shapes."""
    leaves, bad = D.document_leaves(A.order_documents(spark, sf), ["o_orderkey"])
    return leaves.unionByName(bad.select("o_orderkey", "reason"), allowMissingColumns=True)


QUERIES.update(
    {
        "evidence_facts": q_evidence_facts,
        "evidence_json": q_evidence_json,
        "document_numbers": q_document_numbers,
        "document_leaves": q_document_leaves,
    }
)


from casewatch.operators import report as R  # noqa: E402
from casewatch.operators import sections as S  # noqa: E402


def _section_outputs(spark, sf, nullable=False):
    ev = _evidence(spark, sf, nullable)
    facts = EV.evidence_facts(ev, GROUP_BY)
    records = S.section_records(ev, GROUP_BY)
    validation = S.validate_sections(records, facts, GROUP_BY)
    return ev, facts, records, validation


def q_section_evidence(spark, sf):
    return S.section_evidence(EV.evidence_facts(_evidence(spark, sf), GROUP_BY), GROUP_BY)


def q_section_prompt(spark, sf):
    return S.section_records(_evidence(spark, sf), GROUP_BY).select(*GROUP_BY, "section_ord", "report_section", "prompt")


def q_prompt_dispatch(spark, sf):
    """E5: every customer asks for a section of its country's report."""
    asked = A.prompt_requests(spark, sf)
    records = S.section_records(_evidence(spark, sf), GROUP_BY)
    prompts, bad = S.dispatch_prompts(asked, records, GROUP_BY)
    prompts = prompts.select("c_custkey", "country", "report_section", F.md5("prompt").alias("prompt_md5"))
    return prompts.unionByName(bad.select("c_custkey", "country", "violation"), allowMissingColumns=True)


def q_fallback_text(spark, sf):
    return S.section_records(_evidence(spark, sf), GROUP_BY).select(*GROUP_BY, "report_section", "text")


def q_generation_audit(spark, sf):
    _, _, _, validated = _section_outputs(spark, sf)
    return S.generation_audit(validated, GROUP_BY).withColumn("validation", F.to_json("validation"))


def q_report_sections(spark, sf):
    return R.report_sections(_evidence(spark, sf), GROUP_BY)


def q_report_document(spark, sf):
    ev, _, _, validated = _section_outputs(spark, sf)
    return R.report_document(ev, validated, GROUP_BY)


def q_limitations_forms(spark, sf):
    """G4 on limitations from outside: lists, objects, empty ones."""
    return A.limitation_texts(spark, sf).select("o_orderkey", R.limitations_text_json(F.col("limitations")).alias("body"))


def q_evidence_facts_null_group(spark, sf):
    return EV.evidence_facts(_evidence(spark, sf, nullable=True), GROUP_BY)


def q_report_document_null_group(spark, sf):
    ev, _, _, validated = _section_outputs(spark, sf, nullable=True)
    return R.report_document(ev, validated, GROUP_BY)


QUERIES.update(
    {
        "evidence_facts_null_group": q_evidence_facts_null_group,
        "report_document_null_group": q_report_document_null_group,
        "section_evidence": q_section_evidence,
        "section_prompt": q_section_prompt,
        "prompt_dispatch": q_prompt_dispatch,
        "limitations_forms": q_limitations_forms,
        "fallback_text": q_fallback_text,
        "generation_audit": q_generation_audit,
        "report_sections": q_report_sections,
        "report_document": q_report_document,
    }
)
