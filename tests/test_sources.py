"""Scans, sinks and the end-to-end run."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from casewatch.config import RunParams
from casewatch.operators.clean import validate_tables
from casewatch.operators.rowset import attach_case_dates
from casewatch.plans.pipeline import preprocess, run
from casewatch.sources import normalize_headers, read_raw, require_columns
from sample_rows import COLUMNS, ROWS, sample_raw


def _tmp():
    return tempfile.mkdtemp(prefix="casewatch-io-", dir="/tmp")


def _write_csv(spark, header):
    d = _tmp()
    spark.createDataFrame(ROWS, ", ".join(f"c{i} string" for i in range(len(COLUMNS)))).toDF(*header) \
        .coalesce(1).write.option("header", "true").csv(d + "/raw")
    return d + "/raw"


def test_read_raw_csv_normalizes_headers(spark):
    header = [f"  {c.upper()} " for c in COLUMNS]
    df = read_raw(spark, _write_csv(spark, header))
    assert df.columns == COLUMNS
    assert dict(df.dtypes)["safetyreportid"] == "string"
    assert df.count() == 5


def test_duplicate_headers_raise(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int").toDF("A", " a")
    with pytest.raises(ValueError, match="equal once normalized"):
        normalize_headers(df)


def test_missing_required_columns_listed(spark):
    df = spark.createDataFrame([("1",)], "safetyreportid string")
    with pytest.raises(ValueError) as e:
        require_columns(df)
    assert "serious" in str(e.value) and "occurcountry" in str(e.value)


def test_missing_path_raises(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_raw(spark, "/tmp/casewatch-no-such-dir/raw.csv")


def test_sentinels_become_null(spark):
    rows = [list(r) for r in ROWS]
    rows[0][10] = "NA"
    d = _tmp()
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS)).write.parquet(d + "/raw")
    df = read_raw(spark, d + "/raw", fmt="parquet")
    assert df.filter(F.col("primarysourcecountry").isNull()).count() == 1


def test_validate_tables(spark):
    t = preprocess(sample_raw(spark), RunParams())
    validate_tables(t.cases, t.reactions, t.drugs)
    with pytest.raises(ValueError, match="several rows"):
        validate_tables(t.cases.unionByName(t.cases), t.reactions, t.drugs)
    with pytest.raises(ValueError, match="The reaction table lacks: reaction_pt"):
        validate_tables(t.cases, t.reactions.drop("reaction_pt"), t.drugs)


def test_attach_case_dates_null_safe(spark):
    rx = spark.createDataFrame([(1, "A"), (None, "B"), (2, "C")], "safetyreportid int, reaction_pt string")
    cases = spark.createDataFrame([(1, "2025-01-01"), (None, "2025-02-01"), (2, None)],
                                  "safetyreportid int, report_date string")
    got = sorted(r["reaction_pt"] for r in attach_case_dates(rx, cases).collect())
    assert got == ["A", "B"]


def test_end_to_end_run_writes_outputs(spark):
    out = _tmp()
    paths = run(sample_raw(spark), out, RunParams())
    for p in paths.values():
        assert os.path.exists(p)
    ev = json.loads(spark.read.text(paths["evidence"]).collect()[0]["value"])
    assert ev["case_summary"]["total_unique_cases"] == 3
    report = "".join(r["value"] for r in spark.read.option("lineSep", "\u0000").text(paths["report"]).collect())
    assert "Safety Report" in report
    assert spark.read.json(paths["audit"]).count() == 5
    assert spark.read.parquet(paths["cases"]).count() == 3


def test_staging_refuses_a_local_folder_on_a_cluster():
    import pytest

    from casewatch.plans.pipeline import ensure_checkpoint_dir

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Session:
        sparkContext = _Context()
        conf = _Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session())


def test_scale_conf_sizes_partitions_from_the_input():
    from casewatch.session import scale_conf

    conf = scale_conf(100 * (1 << 40))  # 100 TiB
    assert conf["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (256 << 20))
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
