"""Leaves of JSON documents of any shape, limitations from outside, number
tokens of other scripts, prompts dispatched by rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from casewatch.config import WHOLE_NUMBER_PATTERN
from casewatch.functions import extract_numbers, number_value
from casewatch.operators import documents as D
from casewatch.operators import grounding as G
from casewatch.operators import report as R
from casewatch.operators import sections as S


def brute_leaves(value, path=""):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in brute_leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in brute_leaves(v, f"{path}[{i}]")]
    if value is None:
        return [(path, "null", None, None)]
    if isinstance(value, bool):
        return [(path, "bool", None, str(value).lower())]
    if isinstance(value, str):
        return [(path, "str", None, value)]
    return [(path, "int" if isinstance(value, int) else "float", float(value), None)]


def made(rng, depth):
    kind = rng.randrange(8 if depth else 6)
    if kind >= 6:
        n = rng.randrange(4)
        return {f"k{i}": made(rng, depth - 1) for i in range(n)} if kind == 6 else [made(rng, depth - 1) for _ in range(n)]
    return [None, True, rng.randrange(-(10**6), 10**6), 12.75, 'text {"[ 4,321 \\', ""][kind]


def test_leaves(spark):
    rng = random.Random(3)
    docs = [{f"a{i}": made(rng, rng.randrange(7)) for i in range(rng.randrange(6))} for _ in range(60)]
    docs += [{"big": 12345678901234567890123, "small": 1e-300, "é": {"x.y": [[[]], {}]}}]
    rows = [(i, json.dumps(d, indent=i % 3, ensure_ascii=bool(i % 2))) for i, d in enumerate(docs)]
    leaves, bad = D.document_leaves(spark.createDataFrame(rows, "id int, value string"), ["id"])
    got = sorted(((r.id, r.path, r.kind, r.value_num, r.value_str) for r in leaves.collect()), key=repr)
    assert got == sorted(((i, *leaf) for i, d in enumerate(docs) for leaf in brute_leaves(d)), key=repr)
    assert bad.count() == 0


def test_documents_that_are_no_objects(spark):
    deep = '{"a":' * 61 + "1" + "}" * 61
    rows = [(1, "[1, 2]"), (2, '{"a": 1'), (3, None), (4, "7"), (5, deep), (6, ' \n{"a": 1}'), (7, "{}"), (8, '"{x"')]
    leaves, bad = D.document_leaves(spark.createDataFrame(rows, "id int, value string"), ["id"])
    assert [tuple(r) for r in leaves.collect()] == [(6, "a", "int", 1.0, None)]
    reasons = {r.id: r.reason for r in bad.collect()}
    assert reasons == {1: D.NOT_AN_OBJECT, 2: D.NOT_JSON, 3: D.NOT_JSON, 4: D.NOT_AN_OBJECT, 5: D.TOO_DEEP, 8: D.NOT_AN_OBJECT}
    assert D.document_leaves(spark.createDataFrame([], "id int, value string"), ["id"])[0].count() == 0


def test_numbers_of_a_document(spark):
    doc = {"n": 3, "share": 12.50, "flag": True, "2024": None, "notes": ["about 1,016 of 7%", {"x": "none"}], "deep": [[[0.1]]]}
    leaves, _ = D.document_leaves(spark.createDataFrame([("g", json.dumps(doc))], "g string, value string"), ["g"])
    got = {r.value for r in G.evidence_numbers_from_facts(leaves, ["g"]).collect()}
    assert got == {3.0, 12.5, 1016.0, 7.0, 0.1}  # names and booleans are no numbers


@pytest.mark.parametrize(
    "limits,want",
    [
        (None, R.NO_LIMITATIONS_TEXT),
        ("[]", R.NO_LIMITATIONS_TEXT),
        (" { } ", R.NO_LIMITATIONS_TEXT),
        ("null", R.NO_LIMITATIONS_TEXT),
        ('["one", "two"]', "- one\n- two"),
        ('{"b": null, "a": null}', R.ONLY_NULL_LIMITATIONS_TEXT),
        ('{"b": [], "a": null}', R.ONLY_NULL_LIMITATIONS_TEXT),
        (
            '{"z": "late", "a": ["x", null, true], "gone": null, "n": 3, "f": false}',
            R.NAMED_LIMITATIONS_INTRO + "\n\n- z: late\n- a: x\n- a: None\n- a: True\n- n: 3\n- f: False",
        ),
    ],
)
def test_limitations(spark, limits, want):
    df = spark.createDataFrame([(limits,)], "l string")
    assert df.select(R.limitations_text_json(F.col("l"))).first()[0] == want
    ev = df.select(F.struct(F.col("l").alias("limitations")).alias("evidence"))
    assert ev.select(R._limitations(ev)).first()[0] == want


@pytest.mark.parametrize(
    "text,want,whole",
    [
        ("1016 of 12345.67", ["101", "6", "123", "45.67"], ["1016", "12345.67"]),
        ("1,016 and 12,345,678.5%", ["1,016", "12,345,678.5%"], ["1,016", "12,345,678.5%"]),
        ("a1 b-2 -3 +4%", ["2", "-3", "+4%"], ["2", "-3", "+4%"]),
        ("1,2345", ["1,234", "5"], ["1", "2345"]),
        ("٣٥ und ７,１２３ 𝟏𝟐", ["٣٥", "７,１２３", "𝟏𝟐"], ["٣٥", "７,１２３", "𝟏𝟐"]),
    ],
)
def test_number_tokens(spark, text, want, whole):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(extract_numbers("t")).first()[0] == want
    tokens = df.select(extract_numbers("t", WHOLE_NUMBER_PATTERN).alias("x"))
    assert tokens.first()[0] == whole
    values = tokens.select(F.transform("x", number_value)).first()[0]
    assert values == [float(x.replace(",", "").replace("%", "")) for x in whole]


def test_dispatch(spark):
    records = spark.createDataFrame(
        [(g, s, f"{g}/{s}") for g in ("x", None) for s in S.SECTIONS], "g string, report_section string, prompt string"
    )
    asked = [(1, "x", " Narrative_Summary "), (2, None, "trend_interpretation"), (3, "x", "nope"), (4, "x", None), (5, "y", "summary_analysis"), (5, "y", "nope")]
    prompts, bad = S.dispatch_prompts(spark.createDataFrame(asked, "id int, g string, section string"), records, ["g"])
    assert sorted((r.id, r.prompt) for r in prompts.collect()) == [(1, "x/narrative_summary"), (2, "None/trend_interpretation")]
    told = sorted((r.id, r.violation) for r in bad.collect())
    listed = "'; choose one of: " + ", ".join(S.SECTIONS)
    assert told == sorted([(3, "No prompt for section 'nope" + listed), (4, "No prompt for section '" + listed), (5, "No prompt for section 'nope" + listed), (5, S.NO_EVIDENCE_TEXT)])
    ungrouped, none = S.dispatch_prompts(
        spark.createDataFrame([(1, "summary_analysis")], "id int, section string"), records.where("g = 'x'").drop("g"), []
    )
    assert ungrouped.first().prompt == "x/summary_analysis" and none.count() == 0
