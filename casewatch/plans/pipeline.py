"""End-to-end composition (G7): clean -> newest version -> target filter ->
case / reaction / drug tables -> metrics -> evidence -> sections -> report.

Plans are lazy but for staging: with ``staged=True`` the case table after the
single shuffle on the case key is written once as a Parquet table under
``spark.checkpoint.dir``, when the plan is built, so a lost executor never
replays the scan and the version pick. ``release`` deletes staged tables once
the results that read them are stored.
"""

from __future__ import annotations

from collections.abc import Sequence
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.config import RunParams
from casewatch.functions import parse_date
from casewatch.operators.clean import clean_columns, coerce_numeric, prepare_cases
from casewatch.operators.counters import ROWS, RunCounters
from casewatch.operators.rowset import (
    explode_drugs,
    explode_reactions,
    filter_to_target,
    latest_version,
    target_match,
)

#: Whether a stored case is kept by the target filter.
MATCHES = "_matches"


@dataclass
class CaseTables:
    raw: DataFrame
    latest: DataFrame
    retained: DataFrame
    cases: DataFrame
    reactions: DataFrame
    drugs: DataFrame
    by: tuple[str, ...]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset in a
    local session (local runs, tests) fall back to a fresh folder under /tmp.
    On a cluster without it, staging raises instead of writing locally."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if sc.master != "local" and not sc.master.startswith("local["):
        # a machine-local folder would be lost with its executor
        raise ValueError("Set spark.checkpoint.dir to a shared folder to stage tables on a cluster.")
    import tempfile

    local = tempfile.mkdtemp(prefix="casewatch-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return local


def stage(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Cut lineage: write the table as Parquet into a fresh folder under the
    cluster's checkpoint folder (shared storage, never a local checkpoint)
    and read it back. A lost executor re-reads the files instead of
    replaying the scans and shuffles before them, and later steps get
    column pruning and filter pushdown on the staged table, which an RDD
    checkpoint (whole serialized rows) cannot give."""
    if not enabled:
        return df
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/casewatch-stage-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables staged in this process (from the ``since``-th on)."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _STAGED[since:]:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    del _STAGED[since:]


def preprocess(
    raw: DataFrame,
    params: RunParams = RunParams(),
    by: Sequence[str] = (),
    substance_col: str = "patient_drug_activesubstance_activesubstancename",
    staged: bool = False,
    counters: RunCounters | None = None,
) -> CaseTables:
    """Preprocess the raw wide table into the three case tables.

    ``by`` columns must be raw columns; they are carried unchanged to all
    three tables so every later aggregate can group on them. ``counters``
    takes the first run counters from the write of the staged table."""
    clean = coerce_numeric(clean_columns(raw))
    if staged:
        # the match is stored with the case, so no later scan searches the substances again
        picked = latest_version(clean, rows_col=ROWS if counters is not None else None)
        picked = picked.withColumn(MATCHES, target_match(substance_col, params.target_pattern) if params.filter_to_target else F.lit(True))
        if counters is not None:
            picked = counters.watch_versions(picked, substance_col, params.target_pattern)
        kept = stage(picked)
        latest, retained = kept.drop(MATCHES, ROWS), kept.where(MATCHES).drop(MATCHES, ROWS)
    else:
        latest = latest_version(clean)
        retained = filter_to_target(latest, substance_col, params.target_pattern, params.filter_to_target)
    with_date = retained.withColumn("case_report_date", parse_date("report_date")) if (
        "report_date" in retained.columns
    ) else retained.withColumn("case_report_date", F.lit(None).cast("date"))
    carry = [*by, "case_report_date"]
    reactions = explode_reactions(with_date, carry=carry, null_sentinels=params.null_sentinels)
    drugs = explode_drugs(retained, pattern=params.target_pattern, carry=list(by), null_sentinels=params.null_sentinels)
    cases = prepare_cases(retained, by)
    return CaseTables(clean, latest, retained, cases, reactions, drugs, tuple(by))


def run(
    raw: DataFrame,
    out_dir: str,
    params: RunParams = RunParams(),
    by: Sequence[str] = (),
    texts: DataFrame | None = None,
) -> dict[str, str]:
    """Clean -> analyze -> report, writing every output; actions happen
    only at the sinks. Returns the output paths (each verified to exist).

    ``texts`` optionally supplies generated section text per (group,
    report_section); otherwise the deterministic fallback text is used. Staged
    tables are deleted whether the run succeeds or not."""
    before = len(_STAGED)
    try:
        return _run(raw, out_dir.rstrip("/"), params, by, texts)
    finally:
        release(raw.sparkSession, before)


def _run(
    raw: DataFrame, out: str, params: RunParams, by: Sequence[str], texts: DataFrame | None
) -> dict[str, str]:
    from casewatch.operators import evidence as EV
    from casewatch.operators import report as R
    from casewatch.operators import sections as S
    from casewatch.sources import sinks

    spark = raw.sparkSession
    counters = RunCounters()
    t = preprocess(raw, params, by, staged=True, counters=counters)
    # written once and read back; the version pick has made the case ids unique,
    # so key validation (C15) is left to tables that come from outside
    tables = {
        "cases": counters.watch_rows(t.cases, "cases_retained"),
        "reactions": counters.watch_rows(t.reactions, "reaction_records"),
        "target_drugs": counters.watch_rows(t.drugs, "target_drug_rows"),
    }
    paths = sinks.write_tables(tables, f"{out}/tables", by)
    stored = sinks.read_tables(spark, paths, {name: df.schema for name, df in tables.items()})
    t = replace(t, cases=stored["cases"], reactions=stored["reactions"], drugs=stored["target_drugs"])
    ev = stage(EV.evidence_struct(EV.evidence_parts(t, params)))
    keys = list(by)
    facts = EV.evidence_facts(ev, keys)
    sinks.write_evidence_json(EV.evidence_json(ev, keys), f"{out}/evidence", keys)
    records = S.section_records(ev, keys, texts)
    validated = stage(S.validate_sections(records, facts, keys))
    model = params.model_name if not params.mock_text else "deterministic-fallback"
    sinks.write_audit(S.generation_audit(validated, keys, model=model, mock=params.mock_text), f"{out}/audit")
    sinks.write_report(R.report_document(ev, validated, keys, params.model_name), f"{out}/report", keys)
    sinks.write_counters(counters.table(spark), f"{out}/counters")
    paths.update({name: f"{out}/{name}" for name in ("evidence", "audit", "report", "counters")})
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, p in paths.items():
        path = jvm.org.apache.hadoop.fs.Path(p)
        if not path.getFileSystem(conf).exists(path):
            raise RuntimeError(f"No {name} output at {p}")
    return paths
