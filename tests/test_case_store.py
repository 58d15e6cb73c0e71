"""Stored cases: deliveries merged one by one give the batch result."""

import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casewatch.operators.rowset import latest_version
from casewatch.sources.case_store import CaseStore, corrected_counts

SCHEMA = "country string, safetyreportid long, safetyreportversion double, note string"


def made(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice(["x", "y", None]), rng.choice([None, 1, rng.randrange(80)]), float(rng.randrange(6)), f"n{rng.randrange(9)}") for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def opened(spark, path, **more):
    return CaseStore(spark, path, spark.createDataFrame([], SCHEMA).schema, **more)


def rows_of(df):
    return sorted(map(tuple, df.select("safetyreportid", "safetyreportversion", "country", "note").collect()), key=repr)


@pytest.mark.parametrize("buckets", [None, 5])
def test_merges_give_the_batch_result(spark, buckets):
    path = tempfile.mkdtemp(prefix="casewatch-store-", dir="/tmp") + "/cases"
    store = opened(spark, path, buckets=buckets)
    assert store.cases().count() == 0
    seen = None
    counts = spark.createDataFrame([], "country string, n long")
    for i in range(3):
        delivery = made(spark, i)
        seen = delivery if seen is None else seen.unionByName(delivery)
        counts = spark.createDataFrame(corrected_counts(counts, store.changes(delivery), ["country"]).collect(), "country string, n long")
        assert store.merge(delivery) == i
        assert rows_of(store.cases()) == rows_of(latest_version(seen))
        assert {r.country: r.n for r in counts.collect()} == Counter(r.country for r in store.cases().collect())
    again = opened(spark, path, buckets=buckets)  # as a later session would
    assert rows_of(again.cases()) == rows_of(latest_version(seen))
    assert again.changes(seen).count() == 0
    again.merge(seen.limit(0))
    assert rows_of(again.cases()) == rows_of(latest_version(seen))
    again.drop_before(3)
    assert again.generations() == [3] and rows_of(again.cases()) == rows_of(latest_version(seen))


def test_ties(spark):
    path = tempfile.mkdtemp(prefix="casewatch-store-", dir="/tmp") + "/cases"
    store = opened(spark, path, tiebreak=["note"])
    store.merge(spark.createDataFrame([("x", 1, 2.0, "b"), ("z", 2, 1.0, None)], SCHEMA))
    store.merge(spark.createDataFrame([("y", 1, 2.0, "a"), ("y", 2, 1.0, "a"), ("y", 1, 1.0, "z")], SCHEMA))
    assert rows_of(store.cases()) == [(1, 2.0, "x", "b"), (2, 1.0, "y", "a")]


def test_an_unfinished_generation_does_not_count(spark):
    path = tempfile.mkdtemp(prefix="casewatch-store-", dir="/tmp") + "/cases"
    store = opened(spark, path)
    store.merge(made(spark, 1))
    before = rows_of(store.cases())
    made(spark, 2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/1")
    assert store.generations() == [0] and rows_of(opened(spark, path).cases()) == before
    delivery = made(spark, 3)
    assert opened(spark, path).merge(delivery) == 1
    assert rows_of(opened(spark, path).cases()) == rows_of(latest_version(made(spark, 1).unionByName(delivery)))


def test_stored_cases_are_not_shuffled(spark):
    path = tempfile.mkdtemp(prefix="casewatch-store-", dir="/tmp") + "/cases"
    store = opened(spark, path)
    store.merge(made(spark, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = store.compared(made(spark, 2)).where(F.col("safetyreportid") > 0)
        plan = named._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = [part for part in plan.split("SortMergeJoin")[1].split("Exchange")][0]
    assert "SortMergeJoin" in plan and "Bucketed: true" in stored and "Exchange" not in stored


def test_expired_cases_leave(spark):
    path = tempfile.mkdtemp(prefix="casewatch-store-", dir="/tmp") + "/cases"
    store = opened(spark, path, keep="note <> 'old'")
    first = spark.createDataFrame([("x", 1, 1.0, "a"), ("x", 2, 1.0, "old"), ("y", None, 1.0, "b"), ("z", 3, 1.0, None)], SCHEMA)
    assert sorted((r.safetyreportid or 0, r.old is None, r.new is None) for r in store.changes(first).collect()) == [(0, True, False), (1, True, False)]
    store.merge(first)
    second = spark.createDataFrame([("x", 1, 2.0, "old"), ("y", None, 0.5, "old")], SCHEMA)
    changed = store.changes(second).collect()
    assert [(r.safetyreportid, r.old.note, r.new) for r in changed] == [(1, "a", None)]
    store.merge(second)
    assert rows_of(store.cases()) == [(None, 1.0, "y", "b")]


def test_stream_of_corrected_counts(spark):
    from casewatch.streaming import CorrectedCounts, start_corrected_counts

    base = tempfile.mkdtemp(prefix="casewatch-stream-", dir="/tmp")
    store = opened(spark, f"{base}/cases", keep="safetyreportversion < 5")
    counts = CorrectedCounts(store, f"{base}/counts", ["country"])
    assert counts.counts().count() == 0
    made(spark, 0).limit(0).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    query = start_corrected_counts(stream, counts, f"{base}/checkpoint")
    state = {}  # a plain model: newest of store and delivery, gone once its version is 5
    try:
        for i in range(3):
            delivery = made(spark, 10 + i, 120)
            delivery.write.mode("append").parquet(f"{base}/in")
            query.processAllAvailable()
            for r in delivery.collect():
                row = (r.safetyreportversion, r.country is not None, r.country or "", r.note)
                state[r.safetyreportid] = max(state.get(r.safetyreportid, row), row)
            state = {k: row for k, row in state.items() if row[0] < 5}
            if i == 1:
                counts.take(delivery)  # a batch that runs again changes nothing
    finally:
        query.stop()
    want = [(k, v, c if known else None, note) for k, (v, known, c, note) in state.items()]
    assert rows_of(store.cases()) == sorted(want, key=repr)
    assert {r.country: r.n for r in counts.counts().collect()} == Counter(c for _, _, c, _ in want)
