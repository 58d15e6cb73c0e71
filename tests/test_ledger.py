"""Semantics ledger traps (FIXTURES.md section 5), one test each."""

import datetime as dt

from pyspark.sql import functions as F

from casewatch.functions import parse_date, percentage, split_packed, strip
from casewatch.operators import metrics as M
from casewatch.operators.clean import add_age, clean_columns, coerce_numeric
from casewatch.operators.rowset import explode_reactions, latest_version


def _one(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_q1_flags_stay_text(spark):
    df = _one(spark, [("1",), (None,), ("1",)], "seriousnessdeath string")
    cases = df.withColumn("serious", F.lit("0"))
    m = M.case_metrics(cases).collect()[0]
    assert m["death_count"] == 2


def test_q3_blank_items_distinct_then_null(spark):
    df = _one(spark, [(1, "A,A,A", ",", None)], "safetyreportid int, patient_reaction_reactionmeddrapt string, "
              "patient_reaction_reactionoutcome string, serious string")
    rows = explode_reactions(df).collect()
    assert len(rows) == 2
    assert all(r["reaction_outcome"] is None and r["reaction_pt"] == "A" for r in rows)


def test_q4_half_even(spark):
    v = spark.range(1).select(percentage(F.lit(1), F.lit(800)).alias("p")).collect()[0]["p"]
    assert v == 0.12


def test_q5_ties_alphabetical(spark):
    df = _one(spark, [("b",), ("a",), ("c",), ("c",)], "reaction_pt string")
    rows = M.top_terms(df, n=2).orderBy("rank").collect()
    assert [r["reaction_pt"] for r in rows] == ["c", "a"]


def test_q6_dates(spark):
    texts = ["20250115", "20251345", "15/01/2025", "01/02/2025", "2025-01", "20250115.0", "  ", "Jan 2025", "2025"]
    df = _one(spark, [(t,) for t in texts], "d string")
    got = [r["p"] for r in df.select(parse_date("d").alias("p")).collect()]
    assert got == [dt.date(2025, 1, 15), None, dt.date(2025, 1, 15), dt.date(2025, 1, 2), dt.date(2025, 1, 1),
                   None, None, dt.date(2025, 1, 1), dt.date(2025, 1, 1)]


def test_q7_non_numeric_ids_collapse(spark):
    df = _one(spark, [("abc", "1"), ("x1", "2"), ("5", "1"), ("1001.5", "1")],
              "safetyreportid string, safetyreportversion string")
    out = latest_version(coerce_numeric(df)).collect()
    assert sorted((r["safetyreportid"] is None, r["safetyreportid"]) for r in out) == [(False, 5), (True, None)]


def test_q8_q9_overlap_and_true(spark):
    df = _one(spark, [("0", "1", "true", "true")],
              "serious string, seriousnessdeath string, seriousnesslifethreatening string, fulfillexpeditecriteria string")
    m = M.case_metrics(df).collect()[0]
    assert m["serious_cases"] == 1 and m["non_serious_cases"] == 1   # both
    only_true = _one(spark, [("true",)], "serious string")
    assert M.case_metrics(only_true).collect()[0]["serious_cases"] == 0   # 'true' is not SER
    assert m["expedite_alert_cases"] == 1 and m["life_threatening_count"] == 1   # but is FLAG
    rx = _one(spark, [("X", "true")], "reaction_pt string, case_serious string")
    assert M.top_terms(rx, serious_only=True).count() == 1   # and RSER


def test_q12_no_reactions(spark):
    rx = spark.createDataFrame([], "reaction_pt string, case_serious string, case_report_date date")
    assert M.reaction_totals(rx).count() == 0
    assert M.reaction_concentration(rx).count() == 0


def test_q19_month_gaps(spark):
    df = _one(spark, [(dt.date(2025, 1, 5),), (dt.date(2025, 3, 1),), (dt.date(2025, 3, 9),)], "report_date date")
    months = {r["month"]: r["n"] for r in M.cases_by_month(df).collect()}
    assert months == {"2025-01": 1, "2025-03": 2}
    t = M.flatten_trend(M.trend_summary(M.cases_by_month(df))).collect()[0]
    assert (t["lowest_month"], t["highest_month"], t["percentage_change"]) == ("2025-01", "2025-03", 100.0)


def test_trend_ties_pick_earliest(spark):
    m = _one(spark, [("2025-02", 5), ("2025-01", 5), ("2025-03", 1), ("2025-04", 1)], "month string, n long")
    t = M.flatten_trend(M.trend_summary(m)).collect()[0]
    assert t["highest_month"] == "2025-01" and t["lowest_month"] == "2025-03"


def test_q20_equal_versions_pinned(spark):
    df = _one(spark, [(1, 2.0, "a"), (1, 2.0, "b"), (1, 1.0, "z")],
              "safetyreportid int, safetyreportversion double, tag string")
    assert latest_version(df).collect()[0]["tag"] == "b"


def test_age_bands_and_units(spark):
    ages = [-1, 0.99, 1, 11.9, 12, 17.9, 18, 64.9, 65, None]
    df = _one(spark, [(None if a is None else str(a), "YEAR ") for a in ages] + [("30", "decade")],
              "patient_patientonsetage string, patient_patientonsetageunit string")
    got = [r["age_group"] for r in add_age(df).collect()]
    assert got == ["infant", "infant", "child", "child", "adolescent", "adolescent", "adult", "adult", "elderly",
                   "unknown", "unknown"]
    months = _one(spark, [("18", "month"), ("730.5", "day")], "patient_patientonsetage string, patient_patientonsetageunit string")
    assert [r["age_years"] for r in add_age(months).collect()] == [1.5, 2.0]


def test_c3_unicode_strip_and_blank(spark):
    df = _one(spark, [("\t value ",), ("　 ",), (None,)], "s string")
    out = [r["s"] for r in clean_columns(df).collect()]
    assert out == ["value", None, None]
    assert df.select(strip("s").alias("x")).collect()[0]["x"] == "value"


def test_split_packed(spark):
    df = _one(spark, [(" a , b ,",), ("",), (None,)], "s string")
    assert [r["x"] for r in df.select(split_packed("s").alias("x")).collect()] == [["a", "b", ""], [], []]


def test_unknown_merges_blank_and_literal(spark):
    df = _one(spark, [("unknown",), (None,), (" ",), ("us",)], "occurcountry string")
    rows = {r["value"]: r["n"] for r in M.value_counts(df, [("c", "occurcountry")]).collect()}
    assert rows == {"unknown": 3, "us": 1}
