"""Quantiles and distinct terms: exact forms against brute force, sketches
against their stated bounds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewatch.operators import distinct_terms as H
from casewatch.operators import metrics as M
from casewatch.operators import quantiles as Q


def made(spark, n=4000, seed=1):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["a", "a", "a", "b", None]),
            f"2024-{rng.randint(1, 12):02d}",
            rng.choice([None, 0.0, -3.5, float(rng.randint(0, 99)), rng.random() * 1e-6, rng.random() * 1e9, rng.gauss(40, 20)]),
        )
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, "g string, month string, v double").repartition(6)


def test_exact_quantiles(spark):
    rows, df = made(spark)
    probs = {"low": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "least": 0.0, "most": 1.0}
    for r in Q.exact_quantiles(df, "v", probs, by=["g"]).collect():
        values = [v for g, _, v in rows if g == r.g and v is not None]
        assert r.n == len(values)
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
    whole = Q.exact_quantiles(df, "v", {"median": 0.5}).collect()
    assert len(whole) == 1 and whole[0].median == pytest.approx(np.median([v for *_, v in rows if v is not None]))


def test_exact_quantiles_small_groups(spark):
    df = spark.createDataFrame([("x", 5.0), ("y", 1.0), ("y", 2.0), ("z", None)], "g string, v double")
    got = {r.g: (r.n, r.q1, r.median, r.q3) for r in Q.exact_quantiles(df, "v", by=["g"]).collect()}
    assert got == {"x": (1, 5.0, 5.0, 5.0), "y": (2, 1.25, 1.5, 1.75)}
    assert Q.exact_quantiles(df.limit(0), "v", by=["g"]).count() == 0


def test_bins_rise_with_the_value(spark):
    values = sorted([0.0, *(s * 10.0**e for e in range(-300, 300, 3) for s in (1, -1))])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bins = [r[0] for r in df.orderBy("v").select(Q._bin(F.col("v"))).collect()]
    assert bins == sorted(bins) and len(set(bins)) == len(bins)


def test_median_holds_no_values_in_a_buffer(spark):
    _, df = made(spark, 50)
    cases = df.select("g", F.col("v").alias("age_years"))
    plan = M.with_age_median(M.case_metrics(cases, ["g"]), cases, ["g"])._jdf.queryExecution().toString()
    assert "median" not in plan.replace("age_median_years", "").replace("_median", "") and "percentile" not in plan


def test_sketches_merge_within_the_bound(spark):
    rows, df = made(spark, 30_000, 2)
    stored = Q.number_sketches(df, "v", ["g", "month"])
    early, late = stored.where("month <= '2024-06'"), stored.where("month > '2024-06'")
    merged = Q.merge_sketches(early, ["g"], late)
    found = Q.sketch_quantiles(merged, by=["g"])
    counts = Q.number_counts(df, "v", ["g"])
    errors = Q.rank_errors(found, counts, Q.QUARTILES, ["g"]).collect()
    assert len(errors) == 3
    assert all(r[f"{q}_error"] <= Q.RANK_ERROR for r in errors for q in Q.QUARTILES)
    sizes = {r.g: r.n for r in found.collect()}
    assert sizes == {g: sum(1 for h, _, v in rows if h == g and v is not None) for g in ("a", "b", None)}
    one = Q.sketch_quantiles(Q.merge_sketches(stored)).collect()
    assert len(one) == 1 and one[0].n == sum(sizes.values())


def test_rank_errors_tell_a_wrong_quantile(spark):
    df = spark.createDataFrame([("g", float(i)) for i in range(100)], "g string, v double")
    wrong = spark.createDataFrame([("g", 100, 60.0)], "g string, n long, median double")
    got = Q.rank_errors(wrong, Q.number_counts(df, "v", ["g"]), {"median": 0.5}, ["g"]).collect()
    assert got[0].median_error == pytest.approx(0.10)


def test_term_sketches(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice(["a", "b", None]), f"term {int(rng.random() ** 3 * 20_000)}", f"2024-0{rng.randint(1, 9)}-01")
        for _ in range(40_000)
    ] + [("a", None, "2024-01-01"), ("a", "", None), ("c", "only", None)]
    df = spark.createDataFrame(rows, "g string, reaction_pt string, d string")
    df = df.withColumn("case_report_date", F.to_date("d"))
    stored = H.term_sketches(df, ["g"])
    months = {(r.g, r.month) for r in stored.select("g", "month").collect()}
    assert ("c", None) in months and len(months) == 28
    old, new = stored.where("month <= '2024-05'"), stored.where("month > '2024-05' OR month IS NULL")
    got = {r.g: r for r in H.estimated_terms(H.unite_terms(old, ["g"], new), ["g"]).collect()}
    for g in ("a", "b", None, "c"):
        terms = [t for h, t, _ in rows if h == g and t]
        assert got[g].total_reaction_occurrences == len(terms)
        assert abs(got[g].unique_reaction_terms - len(set(terms))) <= H.RELATIVE_ERROR * len(set(terms)) + 1
    whole = H.estimated_terms(H.unite_terms(stored)).collect()[0]
    distinct = len({t for _, t, _ in rows if t})
    assert abs(whole.unique_reaction_terms - distinct) <= H.RELATIVE_ERROR * distinct + 1
