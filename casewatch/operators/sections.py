"""Section evidence, prompts, fallback text and audit records (E1-E7) as one
DataFrame row per (group, section) — no per-section driver loop.

Prompts are built from the evidence struct with ``to_json`` (compact, key
order kept, non-ASCII kept). The deterministic fallback text re-emits the
prompt's evidence JSON with Python's default ``", "`` / ``": "`` separators,
done with JVM regex passes that only touch separators outside strings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.config import (
    FALLBACK_MODEL,
    FALLBACK_NO_EVIDENCE,
    FALLBACK_UNPARSABLE,
    GROUNDING_RULES,
    NO_EVIDENCE_TEXT,
    PROMPT_CLOSING,
    SECTION_INSTRUCTIONS,
    SECTION_MAP,
    SECTION_TITLES,
    UNKNOWN_SECTION_TEXT,
)
from casewatch.operators import grounding as G
from casewatch.functions import extract_numbers, lower_strip, number_value, strip
from casewatch.functions.joins import join_null_safe

SECTIONS = [name for name, _ in SECTION_MAP]
TITLES = dict(SECTION_TITLES)
INSTRUCTIONS = dict(SECTION_INSTRUCTIONS)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


GROUP = "_g"


def group_keys(by: Sequence[str]) -> list[str]:
    """Join keys: the group columns, or a constant key when ungrouped (so
    every join stays an equi-join)."""
    return list(by) if by else [GROUP]


def with_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by or GROUP in df.columns else df.withColumn(GROUP, F.lit(0))


def section_map(spark) -> DataFrame:
    """E1 mapping ``(report_section, section_ord, section, key_ord)`` — a
    fixed 23-row literal table (safe to broadcast)."""
    rows = [
        (name, i + 1, key, j + 1)
        for i, (name, keys) in enumerate(SECTION_MAP)
        for j, key in enumerate(keys)
    ]
    return spark.createDataFrame(rows, "report_section string, section_ord int, section string, key_ord int")


def section_evidence(facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Evidence facts of each report section (the un-compacted slice)."""
    m = F.broadcast(section_map(facts.sparkSession))
    return facts.join(m, on="section", how="inner").select(
        *[_q(k) for k in by], "report_section", "section", "path", "key", "ord", "kind", "value_num", "value_str"
    )


# -- E3: compaction per section (reads only keys present in the slice) ----------

def _without_available(c: Column, fields: Sequence[str]) -> Column:
    """Drop ``available`` keys by projecting the other fields."""
    return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*[c[f].alias(f) for f in fields]))


def _rate(c: Column) -> Column:
    return _without_available(c, ["count", "percentage"])


def compact_evidence(ev: Column, section: str, available: Sequence[str] | None = None) -> Column:
    """Section-specific compaction of the evidence handed to the prompt.

    ``available`` lists the top-level keys that evidence holds (default: the
    section's slice). Keys it does not hold read as null, as in the reference
    (e.g. the narrative summary asks for reactions and alerts, which its
    slice does not supply)."""
    if section not in dict(SECTION_MAP):
        raise ValueError(_unknown_section(section))
    has = set(dict(SECTION_MAP)[section] if available is None else available)

    def get(k: str) -> Column:
        # a key the slice does not supply reads as a null of the same type
        return ev[k] if k in has else F.when(F.lit(False), ev[k])

    cs, ser, demo, rx, tr = get("case_summary"), get("seriousness"), get("demographics"), get("reactions"), get("trends")
    oc = get("outcomes")
    outcomes = F.when(oc.isNotNull(), F.struct(oc["reaction_outcome_distribution"].alias("reaction_outcome_distribution")))
    rp = get("reporting_period")
    period = F.struct(rp["start_date"].alias("start_date"), rp["end_date"].alias("end_date"),
                      rp["number_of_months"].alias("number_of_months"))
    ct = tr["case_trends"]
    trend_keys = ["highest_month", "lowest_month", "first_month", "last_month", "absolute_change", "percentage_change"]

    def sev(k: str) -> Column:
        return _rate(ser[k])

    alerts = get("alerts")
    if section == "narrative_summary":
        return F.struct(
            F.when(rp.isNotNull(), period).alias("reporting_period"),
            F.struct(
                cs["total_unique_cases"].alias("total_cases"),
                cs["serious_cases"].alias("serious_cases"),
                cs["non_serious_cases"].alias("non_serious_cases"),
                cs["serious_percentage"].alias("serious_percentage"),
                cs["expedite_alert_cases"].alias("expedite_cases"),
                cs["expedite_alert_percentage"].alias("expedite_percentage"),
            ).alias("case_summary"),
            F.struct(
                sev("death").alias("death"),
                sev("life_threatening").alias("life_threatening"),
                F.struct(*[sev(k).alias(k) for k in ("hospitalization", "disability", "congenital_anomaly", "other_serious")]).alias(
                    "medical_event"
                ),
            ).alias("seriousness"),
            F.struct(
                F.struct(demo["age_group_distribution"].alias("groups")).alias("age"),
                demo["sex_distribution"].alias("sex"),
            ).alias("demographics"),
            F.struct(rx["total_reaction_occurrences"].alias("total"), rx["most_frequent_reactions"].alias("top")).alias(
                "reactions"
            ),
            outcomes.alias("outcomes"),
            alerts.alias("alerts"),
        )
    if section == "summary_analysis":
        return F.struct(
            F.struct(*[cs[k].alias(k) for k in (
                "total_unique_cases", "serious_cases", "non_serious_cases", "serious_percentage",
                "expedite_alert_cases", "expedite_alert_percentage")]).alias("cases"),
            F.struct(
                sev("death").alias("death"),
                sev("life_threatening").alias("life_threatening"),
                F.struct(*[sev(k).alias(k) for k in ("hospitalization", "disability", "congenital_anomaly", "other_serious")]).alias(
                    "other_serious"
                ),
            ).alias("seriousness"),
            F.struct(demo["age_group_distribution"].alias("age_groups"), demo["sex_distribution"].alias("sex")).alias(
                "demographics"
            ),
            F.struct(rx["total_reaction_occurrences"].alias("total"), rx["most_frequent_reactions"].alias("top")).alias(
                "reactions"
            ),
            outcomes.alias("outcomes"),
            F.struct(*[ct[k].alias(k) for k in trend_keys]).alias("trends"),
        )
    if section == "reaction_analysis":
        top = rx["most_frequent_reactions"]
        conc = rx["reaction_concentrations"]
        picked = F.filter(
            F.transform(F.slice(F.map_keys(top), 1, 5), lambda k: F.struct(k.alias("k"), conc[k].alias("v"))),
            lambda e: e["v"].isNotNull(),
        )
        return F.struct(
            rx["total_reaction_occurrences"].alias("total_reaction_occurrences"),
            rx["unique_reaction_terms"].alias("unique_reaction_terms"),
            top.alias("most_frequent_reactions"),
            rx["most_frequent_serious_reactions"].alias("most_frequent_serious_reactions"),
            F.map_from_entries(picked).alias("reaction_concentrations"),
        )
    if section == "serious_alert_analysis":
        return F.struct(
            F.struct(*[cs[k].alias(k) for k in (
                "total_unique_cases", "serious_cases", "non_serious_cases", "unknown_seriousness",
                "serious_percentage", "expedite_alert_cases", "expedite_alert_percentage")]).alias("case_summary"),
            F.struct(*[sev(k).alias(k) for k in (
                "death", "life_threatening", "hospitalization", "disability", "congenital_anomaly", "other_serious"
            )]).alias("seriousness"),
            alerts.alias("alerts"),
            outcomes.alias("outcomes"),
        )
    if section == "trend_interpretation":
        return F.struct(
            period.alias("reporting_period"),
            F.struct(*[ct[k].alias(k) for k in trend_keys]).alias("case_trend_summary"),
        )
    raise ValueError(_unknown_section(section))


def _unknown_section(section: str) -> str:
    return UNKNOWN_SECTION_TEXT[0] + section + UNKNOWN_SECTION_TEXT[1] + ", ".join(SECTIONS)


def _slice(ev: Column, section: str) -> Column:
    """The un-compacted slice ``{key: evidence[key]}`` for a section."""
    return F.struct(*[ev[k].alias(k) for k in dict(SECTION_MAP)[section]])


def get_prompt(ev: Column, section: str, available: Sequence[str] | None = None) -> Column:
    """E5: prompt for a section name (stripped, lower-cased); an unknown name
    raises listing the supported ones."""
    name = section.strip().lower()
    compact = F.to_json(compact_evidence(ev, name, available), {"ignoreNullFields": "false"})
    return prompt_text(compact, name)


def dispatch_prompts(
    requests: DataFrame, records: DataFrame, by: Sequence[str], section_col: str = "section"
) -> tuple[DataFrame, DataFrame]:
    """E5 as data: each request names a section in a column and gets the prompt
    of its group. Returns (prompts, violations), every request in exactly one:
    ``requests`` with ``report_section`` and ``prompt``, or with ``violation``.

    Names are stripped and lower-cased. A request is a violation if its section is
    unknown (the message lists the supported ones) or if its group has no
    evidence. ``records`` is one row per (group, section) as made by
    ``section_records``; a group with most of the requests is dealt over tasks by
    the join, whose other side has five rows a group."""
    name = lower_strip(_q(section_col))
    asked = with_group(requests, by).withColumn("report_section", name)
    keys = group_keys(by)
    table = with_group(records, by).select(*[_q(k) for k in keys], "report_section", "prompt")
    found = join_null_safe(asked, table, keys, plain=["report_section"])
    known = F.coalesce(F.col("report_section").isin(SECTIONS), F.lit(False))
    shown = F.coalesce(_q(section_col), F.lit(""))
    unknown = F.concat(F.lit(UNKNOWN_SECTION_TEXT[0]), shown, F.lit(UNKNOWN_SECTION_TEXT[1] + ", ".join(SECTIONS)))
    violation = F.when(~known, unknown).otherwise(F.lit(NO_EVIDENCE_TEXT))
    cols = [_q(c) for c in requests.columns]
    prompts = found.where(F.col("prompt").isNotNull()).select(*cols, "report_section", "prompt")
    return prompts, found.where(F.col("prompt").isNull()).select(*cols, violation.alias("violation"))


def prompt_text(evidence_json: Column, section: str) -> Column:
    """Rules + title + task + evidence JSON + closing line."""
    prefix = ("\n" + GROUNDING_RULES + "\n\nSECTION:\n" + TITLES[section] + "\n\nTASK:\n"
              + INSTRUCTIONS[section] + "\n\nEVIDENCE:\n").lstrip()
    return F.concat(F.lit(prefix), evidence_json, F.lit("\n\n" + PROMPT_CLOSING))


_JSON_TOKEN = r'("(?:[^"\\]|\\.)*")|([,:])'


def python_json_spacing(compact: Column) -> Column:
    """Compact JSON -> Python ``json.dumps`` default spacing (", " and ": ")
    without touching commas or colons inside strings."""
    marked = F.regexp_replace(compact, _JSON_TOKEN, "$1$2\u0001")
    return F.regexp_replace(F.regexp_replace(marked, '"\u0001', '"'), "\u0001", " ")


def fallback_text(prompt: Column) -> Column:
    """The evidence JSON cut out of the prompt and re-serialized; fixed
    messages when the marker is missing or the JSON does not parse."""
    marker = "EVIDENCE:"
    after = F.substring(prompt, F.instr(prompt, marker) + len(marker), F.lit(2**31 - 1))
    cut = strip(F.substring_index(after, PROMPT_CLOSING, 1))
    parsed = F.try_parse_json(cut)
    return (
        F.when(F.instr(prompt, "EVIDENCE:") == 0, F.lit(FALLBACK_NO_EVIDENCE))
        .when(parsed.isNull(), F.lit(FALLBACK_UNPARSABLE))
        .otherwise(python_json_spacing(cut))
    )


def section_records(struct_df: DataFrame, by: Sequence[str], texts: DataFrame | None = None) -> DataFrame:
    """``(group..., section_ord, report_section, evidence_json,
    compact_json, prompt, text)`` — five rows per group, built with one
    ``inline`` over a literal-length array (no join, no loop).

    ``texts`` may supply generated text per (group, report_section); without
    it the deterministic fallback text is used (mock mode)."""
    ev = F.col("evidence")
    struct_df = with_group(struct_df, by)
    user_by, by = by, group_keys(by)
    opts = {"ignoreNullFields": "false"}
    rows = []
    for i, name in enumerate(SECTIONS):
        compact = F.to_json(compact_evidence(ev, name), opts)
        rows.append(
            F.struct(
                F.lit(i + 1).alias("section_ord"),
                F.lit(name).alias("report_section"),
                F.to_json(_slice(ev, name), opts).alias("evidence_json"),
                prompt_text(compact, name).alias("prompt"),
            )
        )
    out = struct_df.select(*[_q(k) for k in by], F.inline(F.array(*rows)))
    if texts is None:
        return out.withColumn("text", strip(fallback_text(F.col("prompt"))))
    texts = with_group(texts, user_by).select(*[_q(k) for k in by], "report_section", "text")
    return join_null_safe(out, texts, by, plain=["report_section"]).withColumn("text", strip(F.col("text")))


def validate_sections(records: DataFrame, facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """F1-F6 on the section texts against each section's own (un-compacted)
    evidence slice. Returns the records with ``valid, unsupported_numbers,
    unsupported_claims, human_review_required`` appended.

    A section's evidence is bounded by construction (top-N lists, months,
    categories), so its numbers are collected into one array per (group,
    section) in a single aggregate, joined once to the records, and every
    check then runs inside the row: no anti-join, no re-aggregation."""
    facts = with_group(facts, by)
    records = with_group(records, by)
    by = group_keys(by)
    ids = [*by, "report_section"]
    sec = section_evidence(facts, by)
    ev = sec.groupBy(*[_q(c) for c in ids]).agg(
        F.array_distinct(F.flatten(F.collect_list(G.fact_numbers()))).alias("_ev")
    )
    joined = join_null_safe(records, ev, by, plain=["report_section"])
    evidence = F.coalesce(F.col("_ev"), F.array().cast("array<double>"))
    text = F.col("text")
    unsupported = F.filter(
        extract_numbers(text),
        lambda t: ~F.coalesce(F.array_contains(evidence, number_value(t)), F.lit(False)),
    )
    claims = F.transform(G.claim_array(text), lambda x: x["finding"])
    valid = (F.size(unsupported) == 0) & (F.size(claims) == 0) & F.coalesce(strip(text) != "", F.lit(False))
    return joined.select(
        "*",
        valid.alias("valid"),
        unsupported.alias("unsupported_numbers"),
        claims.alias("unsupported_claims"),
        (~valid).alias("human_review_required"),
    ).drop("_ev")


def generation_audit(validated: DataFrame, by: Sequence[str], model: str = FALLBACK_MODEL,
                     mock: bool = True) -> DataFrame:
    """One audit record per (group, section), from the validated records."""
    return validated.select(
        *[_q(c) for c in by],
        "section_ord",
        F.col("report_section").alias("section"),
        F.col("evidence_json").alias("evidence"),
        "prompt",
        "text",
        F.struct("valid", "unsupported_numbers", "unsupported_claims", "human_review_required").alias("validation"),
        F.lit(mock).alias("mock_llm"),
        F.lit(model).alias("model"),
    )
