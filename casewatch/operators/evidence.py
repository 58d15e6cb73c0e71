"""Evidence document (A13, A19) for any number of groups in one job.

``evidence_parts`` runs four partial+final aggregates keyed by the group
columns, whatever the number of groups: case scalars, counts over case
dimensions, counts over reaction dimensions, drug counts; ranked dimensions
are cut to their top-N with a group limit, reaction totals are summed from
the full counts. ``evidence_struct``
collects the bounded count rows per group once and builds the nested
evidence document (a Spark struct with ordered maps) in one projection.
``evidence_facts`` flattens that struct into a long table by walking its
schema at plan time, so facts and JSON can never disagree.

Maps hold bounded collections only: top-N lists, category counts and months.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
)

from pyspark.sql import Window

from casewatch.config import (
    ALERT_INTERPRETATIONS,
    FURTHER_VALUES,
    METADATA,
    REACTION_SERIOUS_VALUES,
    SERIOUSNESS_FLAGS,
    RunParams,
)
from casewatch.functions import is_in_set, month_of, percentage
from casewatch.functions.joins import join_null_safe
from casewatch.operators import metrics as M
from casewatch.plans.pipeline import CaseTables

GROUP = M.GROUP


@dataclass
class EvidenceParts:
    """The few wide aggregates the evidence document is built from."""

    by: list[str]           # effective group keys (``_g`` when ungrouped)
    user_by: list[str]      # group keys as the caller gave them
    params: RunParams
    cases_columns: list[str]
    metrics: DataFrame      # one row per group: every case-level scalar
    counts: DataFrame       # (group, dimension, value, n, ord): top-N of ranked dims, all of the rest
    reaction_totals: DataFrame  # one row per group: totals over ALL term counts
    drug_counts: DataFrame  # one row per group


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# Dimensions counted per group. Months keep only dated rows; the ``term``
# dimension keeps null terms (they stay in the concentration denominator).
CASE_DIMENSIONS = ("age_group_distribution", "sex_distribution", "primary_source_country",
                   "occurrence_country", "cases_by_month")
REACTION_DIMENSIONS = ("term", "serious_term", "reaction_outcome_distribution", "frequency_by_month")
MONTH_DIMENSIONS = ("cases_by_month", "frequency_by_month")
TOP_DIMENSIONS = ("primary_source_country", "occurrence_country", "term", "serious_term")
# Free text whose values are all listed, up to a number of values that no category has.
LISTED_DIMENSIONS = ("sex_distribution", "reaction_outcome_distribution")


def _dimension_counts(df: DataFrame, dims: list[tuple[str, Column]], by: Sequence[str]) -> DataFrame:
    """Unpivot several value expressions and count them in ONE aggregate
    (one shuffle, partial aggregation map-side): ``(by..., dimension, value, n)``.
    Entries whose value is null are dropped unless the dimension is ``term``."""
    entries = F.array(*[F.struct(F.lit(d).alias("dimension"), v.cast("string").alias("value")) for d, v in dims])
    long = df.select(*[_q(k) for k in by], F.inline(entries)).filter(
        F.col("value").isNotNull() | (F.col("dimension") == "term")
    )
    return long.groupBy(*[_q(k) for k in by], "dimension", "value").agg(F.count(F.lit(1)).alias("n"))


def evidence_parts(t: CaseTables, params: RunParams = RunParams()) -> EvidenceParts:
    """Four aggregates over the case tables, whatever the number of groups:
    case scalars, case dimension counts, reaction dimension counts, drug
    counts. Everything else is derived from their (small) outputs."""
    by = list(t.by) if t.by else [GROUP]
    add = (lambda df: df) if t.by else (lambda df: df.withColumn(GROUP, F.lit(0)))
    cases, reactions, drugs = add(t.cases), add(t.reactions), add(t.drugs)

    metrics = M.with_age_median(M.case_metrics(cases, by), cases, by)
    case_counts = _dimension_counts(
        cases,
        [
            ("age_group_distribution", M.unknown_if_blank("age_group")),
            ("sex_distribution", M.unknown_if_blank("patient_patientsex")),
            ("primary_source_country", M.unknown_if_blank("primarysourcecountry")),
            ("occurrence_country", M.unknown_if_blank("occurcountry")),
            ("cases_by_month", month_of("report_date")),
        ],
        by,
    )
    term = _q("reaction_pt")
    rx_counts = _dimension_counts(
        reactions,
        [
            ("term", term),
            ("serious_term", F.when(is_in_set("case_serious", REACTION_SERIOUS_VALUES) & (term != ""), term)
             if "case_serious" in reactions.columns else F.lit(None)),
            ("reaction_outcome_distribution", M.unknown_if_blank("reaction_outcome")),
            ("frequency_by_month", month_of("case_report_date")),
        ],
        by,
    )
    counts = case_counts.unionByName(rx_counts)
    # Ranked dimensions (terms, countries) may hold millions of distinct
    # values per group: ``row_number() <= limit`` is planned as a partial
    # WindowGroupLimit before the exchange, so no task sorts a whole group.
    # Free-text categories (sex, outcome) are cut at ``max_values`` in the same
    # window; what lies behind is one further count in the document. Every value
    # of the bounded dimensions (age bands, months) is its own window partition
    # and passes. One pass, one aggregate per family, no re-scan.
    ranked = F.col("dimension").isin(*TOP_DIMENSIONS, *LISTED_DIMENSIONS)
    w = Window.partitionBy(
        *[_q(k) for k in by], "dimension", F.when(~ranked, F.col("value"))
    ).orderBy(F.col("value").isNull(), F.desc("n"), F.asc("value"))
    limit = max(params.top_n, params.top_k)
    top = counts.withColumn("ord", F.row_number().over(w)).filter(F.col("ord") <= max(limit, params.max_values))
    allowed = F.when(F.col("dimension").isin(*LISTED_DIMENSIONS), F.lit(params.max_values)).otherwise(F.lit(limit))
    top = top.filter(F.col("ord") <= allowed)
    # Totals need every term row: a second partial + final aggregate over the
    # same counts (no filter in between, so the count exchange is reused).
    is_term = F.col("dimension") == "term"
    named = F.col("value").isNotNull() & (F.col("value") != "")
    reaction_totals = counts.groupBy(*[_q(k) for k in by]).agg(
        F.sum(F.when(is_term & named, F.col("n"))).alias("total_reaction_occurrences"),
        F.count_if(is_term & named).alias("unique_reaction_terms"),
        F.sum(F.when(is_term, F.col("n"))).alias("reaction_records"),
        F.sum(F.when(F.col("dimension") == "frequency_by_month", F.col("n"))).alias("dated_reactions"),
    )

    drug_counts = drugs.groupBy(*[_q(k) for k in by]).agg(F.count(F.lit(1)).alias("drug_records"))
    return EvidenceParts(by, list(t.by), params, t.cases.columns, metrics, top, reaction_totals, drug_counts)


# -- nested document ---------------------------------------------------------------

def _empty_map(value_type: str) -> Column:
    return F.create_map().cast(f"map<string,{value_type}>")


def evidence_struct(p: EvidenceParts) -> DataFrame:
    """``(group..., evidence)``: the nested evidence document per group.

    The count rows needed by the document (category and month counts,
    top-N terms) are collected once per group — a bounded set: top-N
    entries, months of the reporting period and at most ``max_values`` values
    a category, the cases of all others under ``Further values`` — then cut
    into ordered maps inside one projection. Trend extremes are folded over
    the month array in the same projection (no extra shuffle)."""
    by = p.by
    n, k = p.params.top_n, p.params.top_k
    # one aggregate per group over the bounded map entries; entries sort by
    # dimension, then months ascending, else count desc, value asc (nulls last)
    entry = F.struct(
        "dimension",
        F.when(F.col("dimension").isin(*MONTH_DIMENSIONS), F.col("value")).alias("s1"),
        F.col("value").isNull().alias("s2"),
        (-F.col("n")).alias("s3"),
        "value",
        "n",
    )
    entries = p.counts.groupBy(*[_q(c) for c in by]).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    df = p.metrics
    for part in (entries, p.reaction_totals, p.drug_counts):
        df = join_null_safe(df, part, by)
    e = F.coalesce(
        F.col("_e"),
        F.array().cast("array<struct<dimension:string,s1:string,s2:boolean,s3:bigint,value:string,n:bigint>>"),
    )

    def dim(d: str, limit: int | None = None, named_only: bool = False) -> Column:
        xs = F.filter(e, lambda x: x["dimension"] == d)
        if named_only:
            xs = F.filter(xs, lambda x: x["value"].isNotNull() & (x["value"] != ""))
        if limit is not None:
            xs = F.slice(xs, 1, limit)
        return xs

    def as_map(xs: Column) -> Column:
        return F.map_from_entries(F.transform(xs, lambda x: F.struct(x["value"], x["n"])))

    def listed(d: str, total: Column) -> Column:
        xs = dim(d)
        rest = total - F.aggregate(xs, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
        further = F.array(F.struct(F.lit(FURTHER_VALUES).alias("value"), rest.alias("n")))
        entries = F.transform(xs, lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))
        return F.map_from_entries(F.when(rest > 0, F.concat(entries, further)).otherwise(entries))

    cbm = dim("cases_by_month")
    rbm = dim("frequency_by_month")
    records = F.coalesce(F.col("reaction_records"), F.lit(0)).cast("long")
    dated = F.coalesce(F.col("dated_reactions"), F.lit(0))
    conc_src = F.filter(dim("term"), lambda x: x["value"].isNotNull())
    conc = F.map_from_entries(
        F.transform(
            F.slice(conc_src, 1, k),
            lambda x: F.struct(
                x["value"],
                F.struct(x["n"].alias("count"), percentage(x["n"], records).alias("percentage_of_reactions")),
            ),
        )
    )
    conc_type = "struct<count:bigint,percentage_of_reactions:double>"

    def month_item(x: Column) -> Column:
        return F.struct(x["value"].alias("month"), x["n"].alias("count"))

    months = F.transform(cbm, month_item)
    first = F.when(F.size(months) > 0, F.element_at(months, 1))
    last = F.when(F.size(months) > 0, F.element_at(months, -1))
    # strict comparisons keep the earliest month among ties
    highest = F.when(F.size(months) > 0, F.aggregate(months, F.element_at(months, 1),
                                                    lambda acc, x: F.when(x["count"] > acc["count"], x).otherwise(acc)))
    lowest = F.when(F.size(months) > 0, F.aggregate(months, F.element_at(months, 1),
                                                   lambda acc, x: F.when(x["count"] < acc["count"], x).otherwise(acc)))
    change = last["count"] - first["count"]

    label = p.params.target_label
    metadata = F.struct(
        *[
            F.lit(label if key == "target_product" else f"{label} ICSR dataset" if key == "source" else v).alias(key)
            for key, v in METADATA
        ]
    )
    period = F.struct(
        F.col("period_available").alias("available"),
        F.col("start_date"),
        F.col("end_date"),
        F.col("number_of_months"),
    )
    case_summary = F.struct(
        "total_unique_cases",
        "serious_cases",
        "non_serious_cases",
        "unknown_seriousness",
        "serious_percentage",
        "non_serious_percentage",
        "expedite_alert_cases",
        "expedite_alert_percentage",
        as_map(cbm).alias("cases_by_month"),
    )
    seriousness = F.struct(
        *[
            F.struct(
                F.col(f"{name}_available").alias("available"),
                F.col(f"{name}_count").alias("count"),
                F.col(f"{name}_percentage").alias("percentage"),
            ).alias(name)
            for name, _ in SERIOUSNESS_FLAGS
        ]
    )
    demographics = F.struct(
        F.struct(
            F.col("age_available_cases").alias("available_cases"),
            F.col("age_missing_cases").alias("missing_cases"),
            F.col("age_minimum_years").alias("minimum_years"),
            F.col("age_maximum_years").alias("maximum_years"),
            F.col("age_mean_years").alias("mean_years"),
            F.col("age_median_years").alias("median_years"),
        ).alias("age"),
        as_map(dim("age_group_distribution")).alias("age_group_distribution"),
        listed("sex_distribution", F.col("total_unique_cases")).alias("sex_distribution"),
        as_map(dim("primary_source_country", n)).alias("primary_source_country"),
        as_map(dim("occurrence_country", n)).alias("occurrence_country"),
    )
    reactions = F.struct(
        F.coalesce("total_reaction_occurrences", F.lit(0)).cast("long").alias("total_reaction_occurrences"),
        F.coalesce("unique_reaction_terms", F.lit(0)).cast("long").alias("unique_reaction_terms"),
        as_map(dim("term", n, named_only=True)).alias("most_frequent_reactions"),
        as_map(dim("serious_term", n, named_only=True)).alias("most_frequent_serious_reactions"),
        as_map(rbm).alias("frequency_by_month"),
        F.when(dated > 0, conc).otherwise(_empty_map(conc_type)).alias("reaction_concentrations"),
    )
    outcomes = F.struct(
        (records > 0).alias("available"),
        F.when(records > 0, listed("reaction_outcome_distribution", records)).alias("reaction_outcome_distribution"),
    )
    trends = F.struct(
        F.struct(
            as_map(cbm).alias("monthly_case_counts"),
            highest.alias("highest_month"),
            lowest.alias("lowest_month"),
            first.alias("first_month"),
            last.alias("last_month"),
            change.cast("long").alias("absolute_change"),
            F.when(first["count"] == 0, F.lit(None).cast("double"))
            .otherwise(percentage(change, first["count"]))
            .alias("percentage_change"),
        ).alias("case_trends"),
        as_map(rbm).alias("reaction_trends"),
    )
    name_of = {col: name for name, col in SERIOUSNESS_FLAGS}
    alert_fields = []
    for alert, col, text in ALERT_INTERPRETATIONS:
        if col not in p.cases_columns:
            continue
        cnt = F.col("expedite_alert_cases") if col == "fulfillexpeditecriteria" else F.col(f"{name_of[col]}_count")
        alert_fields.append(
            F.struct(cnt.alias("count"), percentage(cnt, "total_unique_cases").alias("percentage"),
                     F.lit(text).alias("interpretation")).alias(alert)
        )
    notes = M.missingness_array(p.cases_columns)
    quality = F.struct(
        F.col("total_unique_cases").alias("cases"),
        records.alias("reaction_records"),
        F.coalesce("drug_records", F.lit(0)).cast("long").alias("drug_records"),
        notes.alias("missingness_notes"),
    )
    evidence = F.struct(
        metadata.alias("metadata"),
        period.alias("reporting_period"),
        case_summary.alias("case_summary"),
        seriousness.alias("seriousness"),
        demographics.alias("demographics"),
        reactions.alias("reactions"),
        outcomes.alias("outcomes"),
        trends.alias("trends"),
        F.struct(*alert_fields).alias("alerts"),
        quality.alias("data_quality"),
        notes.alias("limitations"),
    )
    out = df.select(*[_q(c) for c in by], evidence.alias("evidence"))
    return out if p.user_by else out.drop(GROUP)


def evidence_json(struct_df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """S4 payload: ``(group..., evidence_json)`` — compact JSON, nulls kept,
    map entries in their evidence order."""
    return struct_df.select(
        *[_q(k) for k in by],
        F.to_json("evidence", {"ignoreNullFields": "false"}).alias("evidence_json"),
    )


# -- long facts ----------------------------------------------------------------------

def _kind(dt: DataType) -> str:
    if isinstance(dt, (LongType, IntegerType)):
        return "int"
    if isinstance(dt, DoubleType):
        return "float"
    if isinstance(dt, BooleanType):
        return "bool"
    return "str"


def _leaf(c: Column, dt: DataType) -> tuple[Column, Column, Column]:
    kind = F.when(c.isNull(), F.lit("null")).otherwise(F.lit(_kind(dt)))
    if isinstance(dt, (LongType, IntegerType, DoubleType)):
        return kind, c.cast("double"), F.lit(None).cast("string")
    if isinstance(dt, BooleanType):
        return kind, F.lit(None).cast("double"), F.lower(c.cast("string"))
    return kind, F.lit(None).cast("double"), c.cast("string")


def evidence_facts(struct_df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A19 long form ``(group..., section, path, key, ord, kind, value_num,
    value_str)`` — one row per leaf of the evidence document.

    Built in ONE projection over the (one-row-per-group) evidence table: the
    schema is walked at plan time, scalars become literal-keyed structs, maps
    and lists become ``transform``-ed entry arrays, everything is concatenated
    and ``inline``-d. ``ord`` is the 1-based position in a map or list (0 for
    scalars); ``key`` is the map key."""
    schema = struct_df.schema["evidence"].dataType
    pieces: list[Column] = []
    scalars: list[Column] = []

    def fact(section: str, path: str | None, key: Column, ord_: Column, v: Column, dt: DataType) -> Column:
        kind, num, s = _leaf(v, dt)
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(path).cast("string").alias("path"),
            key.cast("string").alias("key"),
            ord_.cast("int").alias("ord"),
            kind.alias("kind"),
            num.alias("value_num"),
            s.alias("value_str"),
        )

    def walk(col: Column, dt: DataType, section: str, path: list[str]) -> None:
        if isinstance(dt, StructType):
            for f in dt.fields:
                if section == "":
                    walk(col[f.name], f.dataType, f.name, [])
                else:
                    walk(col[f.name], f.dataType, section, path + [f.name])
            return
        p = ".".join(path) if path else None
        if isinstance(dt, MapType):
            vt = dt.valueType
            fields = vt.fields if isinstance(vt, StructType) else [None]
            for f in fields:
                sub = p if f is None else f"{p}.{f.name}"
                arr = F.transform(F.map_entries(col), _entry_fact(fact, section, sub, f, vt))
                pieces.append(F.coalesce(arr, F.array().cast(f"array<{_FACT}>")))
            return
        if isinstance(dt, ArrayType):
            arr = F.transform(
                col, lambda x, i: fact(section, p, F.lit(None), i + 1, x, dt.elementType)
            )
            pieces.append(F.coalesce(arr, F.array().cast(f"array<{_FACT}>")))
            return
        scalars.append(fact(section, p, F.lit(None), F.lit(0), col, dt))

    walk(F.col("evidence"), schema, "", [])
    all_facts = F.concat(F.array(*scalars), *pieces)
    return struct_df.select(*[_q(k) for k in by], F.inline(all_facts))


def _entry_fact(fact, section, sub, field, vt):
    def build(e, i):
        value = e["value"] if field is None else e["value"][field.name]
        return fact(section, sub, e["key"], i + 1, value, vt if field is None else field.dataType)

    return build


_FACT = (
    "struct<section:string,path:string,key:string,ord:int,kind:string,"
    "value_num:double,value_str:string>"
)
