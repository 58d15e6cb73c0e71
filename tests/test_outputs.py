"""Counters from writes, sinks that keep text as it is, evidence that lists a
bounded number of free-text values."""

import json
import tempfile

from pyspark.sql import functions as F

from casewatch.config import FURTHER_VALUES, RunParams
from casewatch.operators import evidence as EV
from casewatch.operators import sections as S
from casewatch.operators.counters import ROWS, RunCounters
from casewatch.operators.rowset import latest_version, pipeline_counters
from casewatch.plans import pipeline
from casewatch.plans.pipeline import preprocess, run
from casewatch.sources import read_evidence_json, read_evidence_text, write_audit, write_evidence_json
from sample_rows import sample_raw


def folder():
    return tempfile.mkdtemp(prefix="casewatch-out-", dir="/tmp")


def test_counters_of_the_staging_write(spark):
    raw = sample_raw(spark).repartition(3)
    counters = RunCounters()
    t = preprocess(raw, RunParams(), staged=True, counters=counters)
    seen = counters.values()
    want = {r.counter: r.value for r in pipeline_counters(t.raw, t.latest, t.retained, t.reactions, t.drugs).collect()}
    assert seen == {k: want[k] for k in ("raw_rows", "unique_ids", "cases_with_target", "cases_without_target")}
    assert seen["raw_rows"] == raw.count() and ROWS not in t.latest.columns


def test_raw_rows_are_counted_by_the_version_pick(spark):
    """The raw table is scanned once, and no counter lies below the shuffle."""
    raw = spark.read.schema("safetyreportid string, safetyreportversion string, s string").csv(folder())
    picked = latest_version(raw, rows_col=ROWS)
    watched = RunCounters().watch_versions(picked, "s")
    plan = watched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.index("CollectMetrics") < plan.index("Exchange")


def test_counters_of_a_run(spark):
    raw = sample_raw(spark)
    paths = run(raw, folder(), RunParams())
    got = {r["counter"]: r["value"] for r in spark.read.json(paths["counters"]).collect()}
    t = preprocess(raw, RunParams())
    assert got == {r.counter: r.value for r in pipeline_counters(t.raw, t.latest, t.retained, t.reactions, t.drugs).collect()}


def test_a_failed_run_frees_its_staged_tables(spark):
    before = len(pipeline._STAGED)
    staged = sample_raw(spark).withColumn("patient_patientsex", F.raise_error(F.lit("bad row")).cast("string"))
    try:
        run(staged, folder(), RunParams())
        raise AssertionError("the run should have failed")
    except Exception as e:
        assert "bad row" in str(e)
    assert len(pipeline._STAGED) == before


def test_audit_keeps_the_evidence_as_written(spark):
    rows = [("007", 1, "s", '{"z":1.50,"a":{"y":null,"b":[2.0,1e3]}}', "p \"q\"\n", None), (None, 2, "t", None, "p", "x")]
    audit = spark.createDataFrame(rows, "product string, section_ord int, section string, evidence string, prompt string, text string")
    out = folder() + "/audit"
    write_audit(audit, out)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert '"evidence":{"z":1.50,"a":{"y":null,"b":[2.0,1e3]}},' in lines[0]
    assert [json.loads(x) for x in lines] == [
        {"product": "007", "section_ord": 1, "section": "s", "evidence": {"z": 1.5, "a": {"y": None, "b": [2.0, 1000.0]}}, "prompt": 'p "q"\n', "text": None},
        {"product": None, "section_ord": 2, "section": "t", "evidence": None, "prompt": "p", "text": "x"},
    ]
    assert list(json.loads(lines[0])) == audit.columns
    alone = folder() + "/audit"
    write_audit(audit.select("evidence"), alone)
    assert sorted(r.value for r in spark.read.text(alone).collect())[1] == '{"evidence":{"z":1.50,"a":{"y":null,"b":[2.0,1e3]}}}'


def test_group_columns_keep_their_text(spark):
    docs = spark.createDataFrame([("007", "1.0", '{"a":1}'), (None, "x", '{"a":2}')], "product string, region string, evidence_json string")
    out = folder() + "/evidence"
    write_evidence_json(docs, out, ["product", "region"])
    by = "product string, region string"
    for declared in (by, None):
        got = {(r.product, r.region): r.value for r in read_evidence_text(spark, out, declared).collect()}
        assert got == {("007", "1.0"): '{"a":1}', (None, "x"): '{"a":2}'}
    schema = spark.range(0).select(F.struct(F.lit(1).cast("long").alias("a")).alias("e")).schema["e"].dataType
    read = read_evidence_json(spark, out, schema, by)
    assert {(r.product, r.evidence.a) for r in read.collect()} == {("007", 1), (None, 2)}


def test_free_text_categories_are_bounded(spark):
    raw = sample_raw(spark)
    many = raw
    for i in range(6):
        more = raw.withColumn("safetyreportid", F.concat(F.lit(f"9{i}"), "safetyreportid")).withColumn("patient_patientsex", F.lit(f"S{i}"))
        many = many.unionByName(more)
    docs = {}
    for limit in (2, 1000):
        params = RunParams(max_values=limit)
        t = preprocess(many, params)
        ev = EV.evidence_struct(EV.evidence_parts(t, params))
        docs[limit] = json.loads(EV.evidence_json(ev).first().evidence_json)
        facts = EV.evidence_facts(ev)
        shown = facts.where("path = 'sex_distribution'").agg(F.sum("value_num")).first()[0]
        assert shown == docs[limit]["case_summary"]["total_unique_cases"]
        assert S.section_records(ev, []).count() == 5
    whole, cut = docs[1000], docs[2]
    for part, name in (("demographics", "sex_distribution"), ("outcomes", "reaction_outcome_distribution")):
        full, short = whole[part][name], cut[part][name]
        assert FURTHER_VALUES not in full and len(full) > 2
        assert list(short)[:2] == list(full)[:2] and list(short)[2:] == [FURTHER_VALUES]
        assert sum(short.values()) == sum(full.values())
        whole[part][name] = cut[part][name] = None
    assert whole == cut
