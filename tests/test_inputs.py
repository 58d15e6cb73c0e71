"""Inputs that real exports hold: null groups, ids written as floats, other
date forms, real lists, supplied texts, re-read outputs."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from casewatch.config import RunParams
from casewatch.functions import parse_date
from casewatch.operators import evidence as EV
from casewatch.operators import grounding as G
from casewatch.operators import report as R
from casewatch.operators import sections as S
from casewatch.operators.clean import add_age, coerce_numeric
from casewatch.operators.rowset import explode_reactions
from casewatch.plans import pipeline
from casewatch.plans.pipeline import preprocess, run
from casewatch.sources.sinks import read_evidence_json
from sample_rows import sample_raw


def test_numeric_coercion(spark):
    rows = [("1001.0", "NaN", "3d"), ("1.0003301E7", "2", "40"), (" 7 ", "1e1", "1.5"), ("8.5", "2f", "NaN"), ("9007199254740993", "-1.", "inf"), ("x", None, None)]
    df = spark.createDataFrame(rows, "safetyreportid string, safetyreportversion string, patient_patientonsetage string")
    got = add_age(coerce_numeric(df)).collect()
    assert [r.safetyreportid for r in got] == [1001, 10003301, 7, None, 9007199254740993, None]
    assert [r.safetyreportversion for r in got] == [0.0, 2.0, 10.0, 0.0, -1.0, 0.0]
    assert [r.age for r in got] == [None, 40.0, 1.5, None, None, None]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("1/5/2025", (2025, 1, 5)),
        ("2025-1-5", (2025, 1, 5)),
        ("15-Jan-2025", (2025, 1, 15)),
        ("15-JAN-2025", (2025, 1, 15)),
        ("2025/01/15", (2025, 1, 15)),
        ("15 Jan 2025", (2025, 1, 15)),
        ("Jan 15, 2025", (2025, 1, 15)),
        ("15 september 2025", (2025, 9, 15)),
        ("January 2025", (2025, 1, 1)),
        ("2025-01-15 10:00", (2025, 1, 15)),
        ("2025-01-15T00:00:00Z", (2025, 1, 15)),
        ("2025-01-15 00:00:00.0", (2025, 1, 15)),
        ("2025-01-15T10:00:00+02:00", (2025, 1, 15)),
        ("25/12/2025", (2025, 12, 25)),
        ("2025", (2025, 1, 1)),
        ("20251345", None),
        ("Monday 2025", None),
        ("n/a", None),
    ],
)
def test_dates(spark, text, want):
    got = spark.range(1).select(parse_date(F.lit(text)).alias("d")).first().d
    assert got == (dt.date(*want) if want else None)


def test_real_lists_are_un_nested(spark):
    df = spark.createDataFrame(
        [(1, [" A ", "B", "A"], ["fatal"])],
        "safetyreportid int, patient_reaction_reactionmeddrapt array<string>, patient_reaction_reactionoutcome array<string>",
    )
    got = sorted((r.reaction_pt, r.reaction_outcome or "") for r in explode_reactions(df).collect())
    assert got == [("A", ""), ("A", "fatal"), ("B", "")]


def test_ragged_lists(spark):
    df = spark.createDataFrame(
        [(1, "A,B,C", "fatal,recovered")], "safetyreportid int, patient_reaction_reactionmeddrapt string, patient_reaction_reactionoutcome string"
    )
    assert [r.reaction_outcome for r in explode_reactions(df).orderBy("reaction_pt").collect()] == ["fatal", "recovered", None]


def _grouped(spark, product):
    raw = sample_raw(spark).withColumn("product", product)
    t = preprocess(raw, RunParams(), by=["product"])
    ev = EV.evidence_struct(EV.evidence_parts(t, RunParams()))
    facts = EV.evidence_facts(ev, ["product"])
    records = S.section_records(ev, ["product"])
    validated = S.validate_sections(records, facts, ["product"])
    return ev, validated, R.report_document(ev, validated, ["product"])


def test_null_group_has_the_same_document_as_a_named_one(spark):
    ev0, checked0, report0 = _grouped(spark, F.lit(None).cast("string"))
    ev1, checked1, report1 = _grouped(spark, F.lit("x"))
    assert ev0.select(F.to_json("evidence")).first() == ev1.select(F.to_json("evidence")).first()
    assert ev0.first()["product"] is None
    verdicts = lambda df: sorted((r.report_section, r.valid) for r in df.collect())
    assert verdicts(checked0) == verdicts(checked1)
    assert report0.first().report == report1.first().report


@pytest.mark.parametrize("by", [[], ["product"]])
def test_supplied_texts(spark, by):
    raw = sample_raw(spark).withColumn("product", F.lit(None).cast("string"))
    t = preprocess(raw, RunParams(), by=by)
    ev = EV.evidence_struct(EV.evidence_parts(t, RunParams()))
    rows = [(None, name, " There were 3 cases. " if i else "It caused 987 things.") for i, name in enumerate(S.SECTIONS)]
    texts = spark.createDataFrame(rows, "product string, report_section string, text string")
    texts = texts if by else texts.drop("product")
    got = {r.report_section: r for r in S.validate_sections(S.section_records(ev, by, texts), EV.evidence_facts(ev, by), by).collect()}
    assert got[S.SECTIONS[0]].unsupported_numbers == ["987"] and not got[S.SECTIONS[0]].valid
    assert got[S.SECTIONS[1]].text == "There were 3 cases." and got[S.SECTIONS[1]].valid


def test_unsupported_numbers_in_a_null_group(spark):
    numbers = spark.createDataFrame([(1, None, 1, "5", 5.0), (1, None, 2, "6", 6.0), (2, "a", 1, "5", 5.0)], "id int, g string, pos int, number string, value double")
    evidence = spark.createDataFrame([(None, 5.0), ("a", 7.0)], "g string, value double")
    got = sorted((r.id, r.number) for r in G.unsupported_numbers(numbers, evidence, ["g"]).collect())
    assert got == [(1, "6"), (2, "5")]


def test_run_with_groups_and_texts_and_re_reads(spark):
    out = tempfile.mkdtemp(prefix="casewatch-io-", dir="/tmp")
    raw = sample_raw(spark).withColumn("product", F.when(F.col("safetyreportid") != "1002", "x"))
    before = len(pipeline._STAGED)
    paths = run(raw, out, RunParams(), by=["product"])
    assert len(pipeline._STAGED) == before  # its staged tables are gone
    assert spark.read.parquet(paths["cases"]).groupBy("product").count().count() == 2
    reports = spark.read.text(paths["report"], wholetext=True).collect()
    assert len(reports) == 2 and all("\0" not in r.value and len(r.value) > 4000 for r in reports)
    audit = spark.read.json(paths["audit"])
    assert dict(audit.dtypes)["evidence"].startswith("struct<")
    t = preprocess(raw, RunParams(), by=["product"])
    ev = EV.evidence_struct(EV.evidence_parts(t, RunParams()))
    schema = ev.schema["evidence"].dataType
    again = {r.product: r.j for r in read_evidence_json(spark, paths["evidence"], schema).select("product", F.to_json("evidence").alias("j")).collect()}
    assert again == {r.product: r.j for r in ev.select("product", F.to_json("evidence").alias("j")).collect()}
    doc = json.loads(spark.read.text(paths["evidence"]).first().value)
    pretty = tempfile.mkdtemp(prefix="casewatch-io-", dir="/tmp") + "/doc.json"
    with open(pretty, "w") as f:
        json.dump(doc, f, indent=2)
    assert read_evidence_json(spark, pretty, schema, pretty=True).first().evidence.metadata.analysis_type
