"""Grounding checks: the reference's unit tests plus the number/phrase traps."""

import json

import pytest
from pyspark.sql import functions as F

from casewatch.config import RunParams
from casewatch.operators import evidence as EV
from casewatch.operators import grounding as G
from casewatch.operators import sections as S
from casewatch.plans.pipeline import preprocess
from sample_rows import sample_raw


def _texts(spark, rows):
    return spark.createDataFrame(rows, "id int, text string")


def _numbers(spark, text):
    df = G.text_numbers(_texts(spark, [(1, text)]), ["id"])
    return [r["number"] for r in df.orderBy("pos").collect()]


def _check(spark, text, evidence_numbers):
    texts = _texts(spark, [(1, text)])
    ev = spark.createDataFrame([(1, float(v)) for v in evidence_numbers], "id int, value double")
    bad = G.unsupported_numbers(G.text_numbers(texts, ["id"]), ev, ["id"])
    return [r["number"] for r in bad.orderBy("pos").collect()]


def test_numbers_supported(spark):
    text = "There were 3 unique cases and 2 serious cases (66.67%)."
    assert "3" in _numbers(spark, text)
    assert _check(spark, text, [3, 2, 66.67]) == []


def test_unsupported_number_flagged(spark):
    assert _check(spark, "There were 99 cases.", [3]) == ["99"]


def test_claims_flagged(spark):
    f = G.claim_findings(_texts(spark, [(1, "This proves that a confirmed safety signal exists.")]), ["id"]).collect()
    assert [r["phrase"] for r in sorted(f, key=lambda r: r["ord"])] == ["proves that", "confirmed safety signal"]


def test_caused_by_gives_two_findings(spark):
    f = G.claim_findings(_texts(spark, [(1, "It was Caused by the drug.")]), ["id"]).collect()
    assert sorted(r["finding"] for r in f) == [
        "Potentially unsupported claim: 'caused by'", "Potentially unsupported claim: 'caused'"]


def test_empty_text_finding(spark):
    f = G.claim_findings(_texts(spark, [(1, ""), (2, None)]), ["id"]).collect()
    assert sorted(r["id"] for r in f) == [1, 2]
    assert {r["finding"] for r in f} == {"Generated text is empty."}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1016", ["101", "6"]),
        ("1,016", ["1,016"]),
        ("2025-07", ["202", "5", "-07"]),
        ("T52", ["2"]),
        ("12345.67", ["123", "45.67"]),
        ("", []),
    ],
)
def test_number_pattern_traps(spark, text, expected):
    assert _numbers(spark, text) == expected


def test_normalized_values_compare(spark):
    # "1,016" and "1016.0" normalize to the same number
    assert _check(spark, "We saw 1,016 cases", [1016]) == []


def test_map_keys_are_not_evidence(spark):
    facts = spark.createDataFrame(
        [(1, "trends", "monthly", "2025-07", 1, "int", 3.0, None)],
        "id int, section string, path string, key string, ord int, kind string, value_num double, value_str string",
    )
    ev = G.evidence_numbers_from_facts(facts, ["id"])
    bad = G.unsupported_numbers(G.text_numbers(_texts(spark, [(1, "2025-07")]), ["id"]), ev, ["id"])
    assert bad.count() == 3


def test_validation(spark):
    texts = _texts(spark, [(1, "3 cases"), (2, "99 cases caused by it"), (3, "   ")])
    ev = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 3.0)], "id int, value double")
    out = {r["id"]: r for r in G.section_validation(texts, ["id"], ["id"], ev).collect()}
    assert out[1]["valid"] and not out[1]["human_review_required"]
    assert not out[2]["valid"] and out[2]["n_unsupported_numbers"] == 1 and out[2]["n_unsupported_claims"] == 2
    assert not out[3]["valid"]


def test_prompt_keeps_supplied_counts(spark):
    t = preprocess(sample_raw(spark), RunParams())
    ev = EV.evidence_struct(EV.evidence_parts(t, RunParams()))
    full = [f.name for f in ev.schema["evidence"].dataType.fields]
    prompt = ev.select(S.get_prompt(F.col("evidence"), " Narrative_Summary ", full).alias("p")).collect()[0]["p"]
    assert "3" in prompt and "Hypotension" in prompt
    body = prompt.split("EVIDENCE:", 1)[1].split("Write only the final section text.", 1)[0]
    assert json.loads(body)["case_summary"]["total_cases"] == 3


def test_unknown_section_raises(spark):
    with pytest.raises(ValueError, match="choose one of: narrative_summary"):
        S.get_prompt(F.col("evidence"), "appendix")


def test_fallback_spacing(spark):
    df = spark.createDataFrame([('x EVIDENCE:\n{"a":1,"b":"c, d: e","m":{"k":[1,2]}}\n\nWrite only the final section text.',)], "p string")
    out = df.select(S.fallback_text(F.col("p")).alias("t")).collect()[0]["t"]
    assert out == json.dumps({"a": 1, "b": "c, d: e", "m": {"k": [1, 2]}})
    missing = spark.createDataFrame([("no marker",), ("EVIDENCE: {bad",)], "p string")
    got = [r["t"] for r in missing.select(S.fallback_text(F.col("p")).alias("t")).collect()]
    assert got == ["Evidence was not supplied for this section.", "Evidence could not be parsed for this section."]
