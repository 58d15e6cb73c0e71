"""Plan shape checks: no Python evaluation, no cartesian products, one
exchange for the version pick, pruned scans."""

import pytest

from casewatch.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_or_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_version_pick_is_one_partial_aggregate_exchange(spark):
    plan = _plan(QUERIES["latest_version"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max(" in plan


def test_lineitem_scan_is_pruned(spark):
    plan = _plan(QUERIES["reaction_distinct"](spark, SF))
    scan = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line][0]
    for unused in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"):
        assert unused not in scan


def _final_plan(df):
    df.collect()  # small results (one row / k rows per group); runs the adaptive plan
    return _plan(df).split("Initial Plan")[0]


def test_concentration_ranks_with_a_partial_group_limit_in_one_pass(spark):
    from casewatch.plans import queries as Q
    from casewatch.operators import metrics as M

    t = Q._evidence_tables(spark, SF)
    plan = _final_plan(M.reaction_concentration(t.reactions, ["country"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("Generate inline(array_distinct") == 1  # reactions un-nested once


def test_evidence_limits_ranked_dimensions_and_reuses_the_count_exchange(spark):
    from casewatch.plans import queries as Q
    from casewatch.operators import evidence as EV

    t = Q._evidence_tables(spark, SF)
    plan = _final_plan(EV.evidence_struct(EV.evidence_parts(t, Q.WIDGET)))
    assert "WindowGroupLimit" in plan
    assert "ReusedExchange" in plan
    # one un-nesting pass for reactions and one for drugs
    assert plan.count("Generate inline(array_distinct") == 2


def test_version_pick_carries_each_column_once(spark):
    from casewatch.operators.rowset import latest_version

    df = spark.createDataFrame([(1, 1.0, "x", "y")], "safetyreportid long, safetyreportversion double, a string, b string")
    for tiebreak in (None, ["a"]):
        plan = latest_version(df, tiebreak=tiebreak)._jdf.queryExecution().optimizedPlan().toString()
        aggregate = next(x for x in plan.splitlines() if "Aggregate" in x)
        assert all(aggregate.count(f"{c}, {c}#") <= 1 for c in ("a", "b", "safetyreportversion"))


def test_validation_does_not_carry_texts_past_the_numbers(spark):
    plan = QUERIES["section_validation"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    generates = [x for x in plan.splitlines() if "Generate posexplode(_values" in x]
    assert generates and not any("text#" in x for x in generates)


def test_concentration_does_not_expand_rows(spark):
    assert "Expand" not in _plan(QUERIES["reaction_concentration"](spark, SF))


def test_staged_cases_keep_the_target_match(spark):
    from casewatch.config import RunParams
    from casewatch.plans.pipeline import preprocess

    from sample_rows import sample_raw

    for params in (RunParams(), RunParams(filter_to_target=False)):
        stored, lazy = preprocess(sample_raw(spark), params, staged=True), preprocess(sample_raw(spark), params)
        assert stored.retained.columns == lazy.retained.columns and stored.latest.columns == lazy.latest.columns
        assert "RLIKE" not in stored.retained._jdf.queryExecution().optimizedPlan().toString()
        for name in ("latest", "retained", "cases", "reactions", "drugs"):
            a, b = getattr(stored, name), getattr(lazy, name)
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_packed_lists_have_no_lambda_per_item(spark):
    from casewatch.plans import adapters as A

    plan = A.packed_lists(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "sort_array" in plan


def test_term_sketches_read_their_reactions_once(spark):
    from casewatch.plans.queries import QUERIES

    read = QUERIES["reaction_term_sketches"](spark, "/root/testdata/sf0.001").inputFiles()
    assert read and not [f for f in read if "lineitem" in f or "orders" in f]


def test_dates_without_letters_skip_the_rewrites(spark):
    from pyspark.sql import functions as F

    from casewatch.functions import parse_date

    texts = {"2020-03-07": "2020-03-07", "2020-13-45": None, "7/13/2020": "2020-07-13", "2020-3": "2020-03-01", "20200307": "2020-03-07",
             "7 mar 2020": "2020-03-07", "MARCH 7, 2020": "2020-03-07", "2020-03-07T10:00": "2020-03-07", "-": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in texts], "d string")
    got = {r.d: r.p for r in df.select("d", F.date_format(parse_date("d"), "yyyy-MM-dd").alias("p")).collect()}
    assert got == texts
