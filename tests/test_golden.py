"""Golden values on the reference's five-row sample (FIXTURES.md section 2)."""

import json

import pytest

from casewatch.config import FIXED_LIMITATIONS, RunParams
from casewatch.operators import evidence as EV
from casewatch.operators import report as R
from casewatch.operators import sections as S
from casewatch.operators.rowset import pipeline_counters
from casewatch.plans.pipeline import preprocess
from sample_rows import sample_raw


@pytest.fixture(scope="module")
def tables(spark):
    return preprocess(sample_raw(spark), RunParams())


@pytest.fixture(scope="module")
def evidence_df(tables):
    return EV.evidence_struct(EV.evidence_parts(tables, RunParams())).cache()


@pytest.fixture(scope="module")
def ev(evidence_df):
    return json.loads(EV.evidence_json(evidence_df).collect()[0]["evidence_json"])


def test_counters(spark, tables):
    raw = sample_raw(spark)
    c = {r["counter"]: r["value"] for r in pipeline_counters(raw, tables.latest, tables.retained, tables.reactions, tables.drugs).collect()}
    assert c == {
        "raw_rows": 5, "unique_ids": 4, "cases_with_target": 3, "cases_without_target": 1,
        "cases_retained": 3, "reaction_records": 6, "target_drug_rows": 3,
    }


def test_case_summary(ev):
    cs = ev["case_summary"]
    assert cs["total_unique_cases"] == 3
    assert (cs["serious_cases"], cs["non_serious_cases"], cs["unknown_seriousness"]) == (2, 1, 0)
    assert cs["expedite_alert_cases"] == 2
    assert (cs["serious_percentage"], cs["non_serious_percentage"], cs["expedite_alert_percentage"]) == (66.67, 33.33, 66.67)
    assert cs["cases_by_month"] == {"2025-01": 1, "2025-03": 1, "2025-06": 1}


def test_seriousness(ev):
    s = ev["seriousness"]
    for k in ("death", "life_threatening", "hospitalization"):
        assert s[k] == {"available": True, "count": 1, "percentage": 33.33}
    for k in ("disability", "congenital_anomaly", "other_serious"):
        assert s[k] == {"available": True, "count": 0, "percentage": 0.0}


def test_demographics(ev):
    d = ev["demographics"]
    assert d["age"] == {"available_cases": 3, "missing_cases": 0, "minimum_years": 45.0, "maximum_years": 81.0,
                        "mean_years": 66.0, "median_years": 72.0}
    assert d["age_group_distribution"] == {"elderly": 2, "adult": 1}
    assert list(d["age_group_distribution"]) == ["elderly", "adult"]
    assert d["sex_distribution"] == {"2": 2, "1": 1}
    assert d["primary_source_country"] == {"de": 1, "in": 1, "us": 1}
    assert d["occurrence_country"] == {"de": 1, "in": 1, "us": 1}


def test_reactions(ev):
    r = ev["reactions"]
    assert r["total_reaction_occurrences"] == 6 and r["unique_reaction_terms"] == 6
    assert r["most_frequent_serious_reactions"] == {
        "Acute kidney injury": 1, "Bradycardia": 1, "Death": 1, "Dizziness": 1, "Hypotension": 1}
    assert list(r["reaction_concentrations"]) == ["Acute kidney injury", "Bradycardia", "Death", "Dizziness", "Fatigue"]
    assert all(v == {"count": 1, "percentage_of_reactions": 16.67} for v in r["reaction_concentrations"].values())
    assert r["frequency_by_month"] == {"2025-01": 3, "2025-03": 2, "2025-06": 1}


def test_outcomes_trends_period(ev):
    assert ev["outcomes"]["available"] is True
    assert ev["outcomes"]["reaction_outcome_distribution"] == {"fatal": 2, "recovering": 2, "recovered": 1, "unknown": 1}
    ct = ev["trends"]["case_trends"]
    assert ct["highest_month"] == ct["lowest_month"] == ct["first_month"] == {"month": "2025-01", "count": 1}
    assert ct["last_month"] == {"month": "2025-06", "count": 1}
    assert ct["absolute_change"] == 0 and ct["percentage_change"] == 0.0
    assert ev["trends"]["reaction_trends"] == {"2025-01": 3, "2025-03": 2, "2025-06": 1}
    assert ev["reporting_period"] == {"available": True, "start_date": "2025-01-20", "end_date": "2025-06-10",
                                      "number_of_months": 6}


def test_quality_and_limitations(ev):
    assert ev["data_quality"]["cases"] == 3
    assert ev["data_quality"]["reaction_records"] == 6
    assert ev["data_quality"]["drug_records"] == 3
    assert ev["limitations"] == list(FIXED_LIMITATIONS)
    assert ev["alerts"]["expedite_cases"]["count"] == 2


def test_drugs(tables):
    rows = sorted((r["safetyreportid"], r["active_substance"], r["route"]) for r in tables.drugs.collect())
    assert rows == [(1001, "BISOPROLOL FUMARATE", "oral"), (1002, "BISOPROLOL", "oral"), (1003, "BISOPROLOL", "oral")]


def test_filter_off(spark):
    t = preprocess(sample_raw(spark), RunParams(filter_to_target=False))
    assert t.cases.count() == 4
    assert t.reactions.count() == 7
    assert t.drugs.count() == 3


def test_facts_match_json(ev, evidence_df):
    facts = EV.evidence_facts(evidence_df).collect()
    by_path = {(f["section"], f["path"], f["key"]): f for f in facts}
    assert by_path[("case_summary", "total_unique_cases", None)]["value_num"] == 3.0
    assert by_path[("case_summary", "cases_by_month", "2025-03")]["ord"] == 2
    assert by_path[("reporting_period", "available", None)]["value_str"] == "true"
    assert len([f for f in facts if f["section"] == "limitations"]) == 4


def test_full_report(spark, evidence_df, tables):
    facts = EV.evidence_facts(evidence_df)
    records = S.section_records(evidence_df, [])
    validated = S.validate_sections(records, facts, [])
    report = R.report_document(evidence_df, validated, []).collect()[0]["report"]
    assert report.startswith("# PADER-Style Safety Report")
    assert report.count("\n## ") == 11
    assert "A total of 3 unique cases were identified." in report
    assert "**Report Status: PENDING HUMAN REVIEW**" in report
    audit = S.generation_audit(validated, []).collect()
    assert [a["section"] for a in sorted(audit, key=lambda a: a["section_ord"])] == S.SECTIONS
    for a in audit:
        json.loads(a["evidence"])
        json.loads(a["text"])  # fallback text is the re-serialized evidence JSON
        assert a["mock_llm"] is True and a["model"] == "deterministic-fallback"
