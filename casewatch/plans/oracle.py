"""DuckDB SQL twins of the registered queries (correctness oracle).

Each string is self-contained ANSI-ish SQL over the pre-registered driver
views. CTE fragments mirror the adapters and operators one to one.
Dialect notes: ``round_even`` = Spark ``bround``; DuckDB has no regex
look-behind (the number pattern uses an equivalent rewrite); DuckDB
``try_cast('1.5' AS BIGINT)`` rounds, so ids are guarded by a digit regex.
"""

from __future__ import annotations

from casewatch.config import (
    ALERT_INTERPRETATIONS,
    DATE_FORMATS,
    DATE_REWRITES,
    FIXED_LIMITATIONS,
    FLAG_VALUES,
    FLAGGED_PHRASES,
    NON_SERIOUS_VALUES,
    NULL_SENTINELS,
    REACTION_SERIOUS_VALUES,
    SERIOUS_VALUES,
)

# --- expression helpers -------------------------------------------------------

_JAVA_TO_STRPTIME = {
    "yyyy-M-d": "%Y-%m-%d",
    "yyyy/M/d": "%Y/%m/%d",
    "M/d/yyyy": "%m/%d/%Y",
    "d/M/yyyy": "%d/%m/%Y",
    "d MMM yyyy": "%d %b %Y",
    "yyyy-M": "%Y-%m",
    "yyyy": "%Y",
}


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def clean(e: str) -> str:
    return f"nullif({strip(e)}, '')"


def lstrip(e: str) -> str:
    return f"lower({strip(e)})"


def inset(e: str, values) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return f"coalesce({lstrip(e)} IN ({vals}), false)"


def pct(part: str, total: str) -> str:
    return (
        f"(CASE WHEN ({total}) = 0 THEN 0.0 "
        f"ELSE round_even((({part})::DOUBLE / ({total})::DOUBLE) * 100.0, 2) END)"
    )


def parse_date(e: str) -> str:
    s = plain = strip(e)
    for pattern, order in DATE_REWRITES:
        plain = f"regexp_replace({plain}, '{pattern}', '{order.replace('$', chr(92))}')"
    free = ", ".join(f"CAST(try_strptime({plain}, '{_JAVA_TO_STRPTIME[f]}') AS DATE)" for f in DATE_FORMATS)
    return (
        f"(CASE WHEN {e} IS NULL OR {s} = '' THEN NULL "
        f"WHEN regexp_full_match({s}, '\\d{{8}}') THEN CAST(try_strptime({s}, '%Y%m%d') AS DATE) "
        f"ELSE coalesce({free}) END)"
    )


_PLAIN = r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?"


def to_double(e: str) -> str:
    return f"(CASE WHEN regexp_full_match(trim({e}), '{_PLAIN}') THEN try_cast(trim({e}) AS DOUBLE) END)"


def to_bigint(e: str) -> str:
    d = to_double(e)
    return (
        f"(CASE WHEN regexp_full_match(trim({e}), '[-+]?\\d+') THEN try_cast(trim({e}) AS BIGINT) "
        f"WHEN {d} = floor({d}) AND abs({d}) <= 9007199254740992 THEN CAST({d} AS BIGINT) END)"
    )


def split_packed(e: str) -> str:
    return (
        f"(CASE WHEN {e} IS NULL OR regexp_full_match({e}, '\\s*') THEN []::VARCHAR[] "
        f"ELSE list_transform(string_split({e}, ','), lambda x: {strip('x')}) END)"
    )


def sentinel_null(e: str) -> str:
    vals = ", ".join("'" + v.replace("'", "''") + "'" for v in NULL_SENTINELS)
    return f"(CASE WHEN nullif({e}, '') IN ({vals}) THEN NULL ELSE nullif({e}, '') END)"


def unknown_if_blank(e: str) -> str:
    return f"coalesce(nullif({strip(e)}, ''), 'unknown')"


def month(e: str) -> str:
    return f"strftime({e}, '%Y-%m')"


# --- adapter CTEs ---------------------------------------------------------------

CORE = """
core AS (
  SELECT o_orderkey,
    CAST(o_orderkey AS VARCHAR) AS safetyreportid,
    '1' AS safetyreportversion,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes ' WHEN '2-HIGH' THEN '1'
         WHEN '3-MEDIUM' THEN '0' WHEN '5-LOW' THEN 'no' END AS serious,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice > 400000 THEN 'yes' ELSE 'no' END AS seriousnessdeath,
    CASE WHEN o_totalprice > 450000 THEN 'true' ELSE 'false' END AS seriousnesslifethreatening,
    CASE WHEN o_orderstatus = 'P' THEN '1' ELSE '0' END AS seriousnesshospitalization,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'yes' ELSE 'no' END AS fulfillexpeditecriteria,
    n_name AS primarysourcecountry,
    r_name AS occurcountry,
    o_orderstatus AS reporttype,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS report_date,
    CASE WHEN o_orderkey % 29 = 0 THEN 'n.k.' WHEN o_orderkey % 31 = 0 THEN '3d'
         ELSE CAST(CAST(floor(abs(c_acctbal) / 100) AS INTEGER) AS VARCHAR) END AS patient_patientonsetage,
    CASE o_orderkey % 5 WHEN 0 THEN 'Year' WHEN 1 THEN 'year' WHEN 2 THEN 'month'
         WHEN 3 THEN 'day' ELSE 'decade' END AS patient_patientonsetageunit,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS patient_patientsex
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

CASE_COLS = [
    "safetyreportid",
    "safetyreportversion",
    "serious",
    "seriousnessdeath",
    "seriousnesslifethreatening",
    "seriousnesshospitalization",
    "fulfillexpeditecriteria",
    "primarysourcecountry",
    "occurcountry",
    "reporttype",
    "report_date",
    "patient_patientonsetage",
    "patient_patientonsetageunit",
    "patient_patientsex",
]

PACKED_COLS = [
    "patient_reaction_reactionmeddrapt",
    "patient_reaction_reactionoutcome",
    "patient_reaction_reactionmeddraversionpt",
    "patient_drug_drugcharacterization",
    "patient_drug_medicinalproduct",
    "patient_drug_activesubstance_activesubstancename",
    "patient_drug_drugadministrationroute",
]

_ORDER = "ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus"

PACKED = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
    coalesce(p_type || ' ' || p_name, '') AS term,
    CASE l_returnflag WHEN 'A' THEN 'Recovered ' WHEN 'N' THEN 'unknown' ELSE '' END AS outcome,
    CAST(l_linenumber AS VARCHAR) AS meddra,
    coalesce(p_brand, '') AS p_brand, coalesce(p_name, '') AS p_name, coalesce(p_type, '') AS p_type
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
),
packed AS (
  SELECT l_orderkey,
    string_agg(term, ',' {_ORDER}) AS patient_reaction_reactionmeddrapt,
    string_agg(outcome, ',' {_ORDER}) AS patient_reaction_reactionoutcome,
    string_agg(meddra, ',' {_ORDER}) AS patient_reaction_reactionmeddraversionpt,
    string_agg(l_linestatus, ',' {_ORDER}) AS patient_drug_drugcharacterization,
    string_agg(p_brand, ',' {_ORDER}) AS patient_drug_medicinalproduct,
    string_agg(p_name, ',' {_ORDER}) AS patient_drug_activesubstance_activesubstancename,
    string_agg(p_type, ',' {_ORDER}) AS patient_drug_drugadministrationroute
  FROM lines GROUP BY l_orderkey
)"""

RAW = f"""{CORE},{PACKED},
raw AS (
  SELECT {", ".join("core." + c for c in CASE_COLS)}, {", ".join("packed." + c for c in PACKED_COLS)}
  FROM core LEFT JOIN packed ON core.o_orderkey = packed.l_orderkey
)"""


def _clean_select(cols, src: str) -> str:
    return ", ".join(f"{clean(c)} AS {c}" for c in cols)


def _typed(cols, src: str, name: str) -> str:
    """C2/C3 then C5 over ``cols`` of ``src``."""
    inner = _clean_select(cols, src)
    outer = []
    for c in cols:
        if c == "safetyreportid":
            outer.append(f"{to_bigint(c)} AS {c}")
        elif c == "safetyreportversion":
            outer.append(f"coalesce({to_double(c)}, 0.0) AS {c}")
        else:
            outer.append(c)
    return f"{name} AS (SELECT {', '.join(outer)} FROM (SELECT {inner} FROM {src}))"


CATEGORICAL = [
    "primarysourcecountry",
    "occurcountry",
    "reporttype",
    "serious",
    "seriousnessdeath",
    "seriousnesslifethreatening",
    "seriousnesshospitalization",
    "fulfillexpeditecriteria",
    "patient_patientsex",
]

_AGE = to_double("patient_patientonsetage")


def _cases_cte(src: str, name: str = "cases", extra: str = "") -> str:
    """prepare_cases: C7, C9, C10-C12, C8."""
    cols = []
    for c in ["safetyreportid", "safetyreportversion", "primarysourcecountry", "occurcountry", "reporttype",
              "report_date", "serious", "seriousnessdeath", "seriousnesslifethreatening",
              "seriousnesshospitalization", "fulfillexpeditecriteria", "patient_patientonsetage",
              "patient_patientonsetageunit", "patient_patientsex"]:
        if c == "report_date":
            cols.append(f"{parse_date(c)} AS report_date")
        elif c in CATEGORICAL:
            cols.append(f"{lstrip(c)} AS {c}")
        else:
            cols.append(c)
    return f"""{name}_a AS (
  SELECT {', '.join(cols)}{extra},
    {_AGE} AS age,
    {lstrip('patient_patientonsetageunit')} AS age_unit
  FROM {src}
),
{name}_b AS (
  SELECT *, CASE age_unit WHEN 'year' THEN age WHEN 'month' THEN age / 12.0::DOUBLE
                 WHEN 'day' THEN age / 365.25::DOUBLE END AS age_years
  FROM {name}_a
),
{name} AS (
  SELECT *, CASE WHEN age_years IS NULL OR isnan(age_years) THEN 'unknown' WHEN age_years < 1 THEN 'infant'
                 WHEN age_years < 12 THEN 'child' WHEN age_years < 18 THEN 'adolescent'
                 WHEN age_years < 65 THEN 'adult' ELSE 'elderly' END AS age_group
  FROM {name}_b
)"""


CASES = f"""WITH {CORE},
{_typed(CASE_COLS, 'core', 'typed')},
{_cases_cte('typed')}"""

RAW_TYPED = f"""{RAW},
{_typed(CASE_COLS + PACKED_COLS, 'raw', 'typed')}"""


def _reactions_cte(src: str, carry: list[str] | None = None) -> str:
    carry = carry or []
    cc = "".join(f", {c}" for c in carry)
    return f"""rx_base AS (
  SELECT safetyreportid{cc},
    serious AS case_serious, seriousnessdeath AS case_death,
    seriousnesslifethreatening AS case_life_threatening,
    seriousnesshospitalization AS case_hospitalization,
    {parse_date('report_date')} AS case_report_date,
    {split_packed('patient_reaction_reactionmeddrapt')} AS rx,
    {split_packed('patient_reaction_reactionoutcome')} AS outc,
    {split_packed('patient_reaction_reactionmeddraversionpt')} AS ver
  FROM {src}
),
rx_pos AS (
  SELECT *, unnest(generate_series(1, len(rx))) AS i FROM rx_base WHERE len(rx) > 0
),
rx_items AS (
  SELECT DISTINCT safetyreportid{cc}, case_serious, case_death, case_life_threatening,
    case_hospitalization, case_report_date,
    {strip('rx[i]')} AS reaction_pt, {lstrip('outc[i]')} AS reaction_outcome, ver[i] AS meddra_version
  FROM rx_pos WHERE {strip('rx[i]')} <> ''
),
reactions AS (
  SELECT safetyreportid{cc}, {sentinel_null('reaction_pt')} AS reaction_pt,
    {sentinel_null('reaction_outcome')} AS reaction_outcome,
    {sentinel_null('meddra_version')} AS meddra_version,
    case_serious, case_death, case_life_threatening, case_hospitalization, case_report_date
  FROM rx_items
)"""


REACTIONS = f"""WITH {RAW_TYPED},
{_reactions_cte('typed')}"""

TARGET = r"\bWIDGET\b"

RETAINED = f"""WITH {RAW_TYPED},
latest AS (
  SELECT * FROM typed
  QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY safetyreportversion DESC) = 1
),
retained AS (
  SELECT * FROM latest
  WHERE coalesce(regexp_matches(upper(patient_drug_activesubstance_activesubstancename), '{TARGET}'), false)
)"""


def _drugs_cte(src: str, carry: list[str] | None = None) -> str:
    carry = carry or []
    cc = "".join(f", {c}" for c in carry)
    return f"""dr_base AS (
  SELECT safetyreportid{cc},
    {split_packed('patient_drug_drugcharacterization')} AS dch,
    {split_packed('patient_drug_medicinalproduct')} AS dpr,
    {split_packed('patient_drug_activesubstance_activesubstancename')} AS dsu,
    {split_packed('patient_drug_drugadministrationroute')} AS dro
  FROM {src}
),
dr_pos AS (
  SELECT *, unnest(generate_series(1, greatest(len(dch), len(dpr), len(dsu), len(dro)))) AS i
  FROM dr_base WHERE greatest(len(dch), len(dpr), len(dsu), len(dro)) > 0
),
dr_items AS (
  SELECT DISTINCT safetyreportid{cc}, {lstrip('dch[i]')} AS drug_characterization, dpr[i] AS medicinal_product,
    upper({strip('dsu[i]')}) AS active_substance, {lstrip('dro[i]')} AS route
  FROM dr_pos WHERE coalesce(regexp_matches(upper(dsu[i]), '{TARGET}'), false)
),
drugs AS (
  SELECT safetyreportid{cc}, {sentinel_null('drug_characterization')} AS drug_characterization,
    {sentinel_null('medicinal_product')} AS medicinal_product,
    {sentinel_null('active_substance')} AS active_substance, {sentinel_null('route')} AS route
  FROM dr_items
)"""


def _vals(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


SER_ANY = " OR ".join(
    inset(c, SERIOUS_VALUES)
    for c in ["serious", "seriousnessdeath", "seriousnesslifethreatening", "seriousnesshospitalization"]
)
NON = inset("serious", NON_SERIOUS_VALUES)

METRICS = f"""{CASES},
metrics AS (
  SELECT count(*) AS total_unique_cases,
    count_if({SER_ANY}) AS serious_cases,
    count_if({NON}) AS non_serious_cases,
    count_if(NOT (({SER_ANY}) OR {NON})) AS unknown_seriousness,
    count_if({inset('fulfillexpeditecriteria', FLAG_VALUES)}) AS expedite_alert_cases,
    count_if({inset('seriousnessdeath', FLAG_VALUES)}) AS death_count,
    count_if({inset('seriousnesslifethreatening', FLAG_VALUES)}) AS life_threatening_count,
    count_if({inset('seriousnesshospitalization', FLAG_VALUES)}) AS hospitalization_count,
    count(age_years) AS age_available_cases,
    count_if(age_years IS NULL) AS age_missing_cases,
    round_even(min(age_years), 2) AS age_minimum_years,
    round_even(max(age_years), 2) AS age_maximum_years,
    round_even(avg(age_years), 2) AS age_mean_years,
    round_even(median(age_years), 2) AS age_median_years,
    count_if(patient_patientsex IS NULL) AS missing_sex,
    count_if(report_date IS NULL) AS missing_dates,
    min(report_date) AS start_d, max(report_date) AS end_d
  FROM cases
)"""


def _sql(*parts: str) -> str:
    return "\n".join(parts)


ORACLE: dict[str, str] = {}

ORACLE["clean_columns"] = _sql(
    f"WITH {CORE}",
    "SELECT "
    + ", ".join(
        (f"lower({clean(c)}) AS {c}" if c in CATEGORICAL else f"{clean(c)} AS {c}") for c in CASE_COLS
    )
    + " FROM core",
)

ORACLE["numeric_coercion"] = """
WITH ids AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 23 = 0 THEN 'ID-' || CAST(o_orderkey AS VARCHAR)
         WHEN o_orderkey % 31 = 0 THEN CAST(o_orderkey AS VARCHAR) || '.5'
         WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) || '.0'
         WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey AS VARCHAR) || '0.0E-1'
         ELSE CAST(o_orderkey AS VARCHAR) END AS safetyreportid,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 'NaN' WHEN o_orderkey % 10 = 0 THEN '3d'
         WHEN o_orderkey % 13 = 0 THEN 'v2'
         ELSE CAST(o_custkey % 7 AS VARCHAR) || '.5' END AS safetyreportversion
  FROM orders
)
SELECT o_orderkey, """ + to_bigint("safetyreportid") + """ AS safetyreportid,
  coalesce(""" + to_double("safetyreportversion") + """, 0.0) AS safetyreportversion
FROM ids"""

_DAY = "CAST(day(o_orderdate) AS VARCHAR)"
_MON = "CAST(month(o_orderdate) AS VARCHAR)"
_DATE_TEXTS_SQL = [
    "strftime(o_orderdate, '%Y%m%d')",
    "strftime(o_orderdate, '%Y-%m-%d')",
    "strftime(o_orderdate, '%m/%d/%Y')",
    "strftime(o_orderdate, '%b %Y')",
    "strftime(o_orderdate, '%Y-%m')",
    f"{_MON} || '/' || {_DAY} || strftime(o_orderdate, '/%Y')",
    f"strftime(o_orderdate, '%Y-') || {_MON} || '-' || {_DAY}",
    "strftime(o_orderdate, '%d-%b-%Y')",
    "upper(strftime(o_orderdate, '%d-%b-%Y')) || ' '",
    "strftime(o_orderdate, '%Y/%m/%d')",
    f"{_DAY} || strftime(o_orderdate, ' %b %Y')",
    f"strftime(o_orderdate, '%b ') || {_DAY} || strftime(o_orderdate, ', %Y')",
    "strftime(o_orderdate, '%B %Y')",
    "strftime(o_orderdate, '%Y-%m-%d 10:00')",
    "strftime(o_orderdate, '%Y-%m-%dT00:00:00Z')",
    "strftime(o_orderdate, '%Y-%m-%d 00:00:00.0')",
]
_DATE_CASES = " ".join(f"WHEN {i} THEN {e}" for i, e in enumerate(_DATE_TEXTS_SQL))
ORACLE["parse_report_date"] = f"""
WITH d AS (
  SELECT o_orderkey AS safetyreportid,
    CASE o_orderkey % {len(_DATE_TEXTS_SQL) + 1} {_DATE_CASES} ELSE 'n/a' END AS date_text
  FROM orders
)
SELECT safetyreportid, date_text, strftime({parse_date('date_text')}, '%Y-%m-%d') AS report_date FROM d"""

ORACLE["age_normalize"] = _sql(
    CASES, "SELECT safetyreportid, age, age_unit, age_years, age_group FROM cases"
)

VERSIONS = f"""
WITH v AS (
  SELECT CASE WHEN o_custkey % 97 = 0 THEN 'unknown' ELSE CAST(o_custkey AS VARCHAR) END AS safetyreportid,
    CASE WHEN o_orderkey % 17 = 0 THEN 'v2' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS safetyreportversion,
    o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS report_date, o_orderstatus AS reporttype
  FROM orders
),
vt AS (
  SELECT {to_bigint(clean('safetyreportid'))} AS safetyreportid,
    coalesce({to_double(clean('safetyreportversion'))}, 0.0) AS safetyreportversion,
    o_orderkey, {clean('report_date')} AS report_date, {clean('reporttype')} AS reporttype
  FROM v
)"""

ORACLE["key_violations"] = _sql(
    VERSIONS,
    "SELECT safetyreportid, count(*) AS n_rows FROM vt GROUP BY safetyreportid HAVING count(*) > 1",
)

ORACLE["latest_version"] = _sql(
    VERSIONS,
    """SELECT safetyreportid, safetyreportversion, o_orderkey, report_date, reporttype FROM vt
QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY safetyreportversion DESC, o_orderkey DESC) = 1""",
)

ORACLE["target_regex_filter"] = _sql(
    RETAINED, "SELECT safetyreportid, patient_drug_activesubstance_activesubstancename FROM retained"
)

ORACLE["semi_join_valid_cases"] = _sql(
    RETAINED,
    """SELECT l_orderkey AS safetyreportid, p_type || ' ' || p_name AS reaction_pt,
  CASE l_returnflag WHEN 'A' THEN 'Recovered ' WHEN 'N' THEN 'unknown' END AS reaction_outcome,
  l_linenumber AS version_tag
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
WHERE l_orderkey IN (SELECT safetyreportid FROM retained)""",
)

ORACLE["reaction_explode"] = _sql(
    REACTIONS,
    """SELECT safetyreportid, reaction_pt, reaction_outcome, meddra_version, case_serious, case_death,
  case_life_threatening, case_hospitalization, strftime(case_report_date, '%Y-%m-%d') AS case_report_date
FROM reactions""",
)

ORACLE["reaction_distinct"] = f"""
WITH r AS (
  SELECT DISTINCT l_orderkey AS safetyreportid, p_type || ' ' || p_name AS reaction_pt,
    {lstrip("CASE l_returnflag WHEN 'A' THEN 'Recovered ' WHEN 'N' THEN 'unknown' END")} AS reaction_outcome,
    l_linenumber AS version_tag
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
)
SELECT safetyreportid, reaction_pt, nullif(reaction_outcome, '') AS reaction_outcome, version_tag FROM r"""

ORACLE["drug_explode_filter"] = _sql(
    f"WITH {RAW_TYPED},",
    _drugs_cte("typed"),
    "SELECT safetyreportid, drug_characterization, medicinal_product, active_substance, route FROM drugs",
)

ORACLE["pipeline_counters"] = _sql(
    RETAINED + ",",
    _reactions_cte("retained") + ",",
    _drugs_cte("retained"),
    """SELECT 'raw_rows' AS counter, (SELECT count(*) FROM raw) AS value
UNION ALL SELECT 'unique_ids', (SELECT count(safetyreportid) FROM latest)
UNION ALL SELECT 'cases_with_target', (SELECT count_if(coalesce(regexp_matches(upper(patient_drug_activesubstance_activesubstancename), '"""
    + TARGET
    + """'), false)) FROM latest)
UNION ALL SELECT 'cases_without_target', (SELECT count(*) - count_if(coalesce(regexp_matches(upper(patient_drug_activesubstance_activesubstancename), '"""
    + TARGET
    + """'), false)) FROM latest)
UNION ALL SELECT 'cases_retained', (SELECT count(*) FROM retained)
UNION ALL SELECT 'reaction_records', (SELECT count(*) FROM reactions)
UNION ALL SELECT 'target_drug_rows', (SELECT count(*) FROM drugs)""",
)

ORACLE["case_summary"] = _sql(
    METRICS,
    f"""SELECT total_unique_cases, serious_cases, non_serious_cases, unknown_seriousness,
  {pct('serious_cases', 'total_unique_cases')} AS serious_percentage,
  {pct('non_serious_cases', 'total_unique_cases')} AS non_serious_percentage,
  expedite_alert_cases,
  {pct('expedite_alert_cases', 'total_unique_cases')} AS expedite_alert_percentage
FROM metrics""",
)

ORACLE["seriousness_rates"] = _sql(
    METRICS,
    f"""SELECT 'death' AS flag, 1 AS ord, true AS available, death_count AS count,
  {pct('death_count', 'total_unique_cases')} AS percentage FROM metrics
UNION ALL SELECT 'life_threatening', 2, true, life_threatening_count,
  {pct('life_threatening_count', 'total_unique_cases')} FROM metrics
UNION ALL SELECT 'hospitalization', 3, true, hospitalization_count,
  {pct('hospitalization_count', 'total_unique_cases')} FROM metrics
UNION ALL SELECT 'disability', 4, false, NULL, NULL FROM metrics
UNION ALL SELECT 'congenital_anomaly', 5, false, NULL, NULL FROM metrics
UNION ALL SELECT 'other_serious', 6, false, NULL, NULL FROM metrics""",
)

ORACLE["age_stats"] = _sql(
    METRICS,
    """SELECT age_available_cases, age_missing_cases, age_minimum_years, age_maximum_years,
  age_mean_years, age_median_years FROM metrics""",
)


def _value_counts(src: str, dims: list[tuple[str, str]], top: int | None = None) -> str:
    unions = " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, {unknown_if_blank(col)} AS value FROM {src}" for name, col in dims
    )
    if top is None:
        return f"SELECT dimension, value, count(*) AS n FROM ({unions}) GROUP BY dimension, value"
    where = f" WHERE rank <= {top}"
    return f"""SELECT * FROM (
  SELECT dimension, value, n,
    row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value ASC) AS rank
  FROM (SELECT dimension, value, count(*) AS n FROM ({unions}) GROUP BY dimension, value)
){where}"""


_DIMS = [
    ("age_group_distribution", "age_group"),
    ("sex_distribution", "patient_patientsex"),
    ("primary_source_country", "primarysourcecountry"),
    ("occurrence_country", "occurcountry"),
]

ORACLE["category_distribution"] = _sql(CASES, _value_counts("cases", _DIMS))
ORACLE["country_top10"] = _sql(CASES, _value_counts("cases", _DIMS[2:], top=10))

ORACLE["reaction_totals"] = _sql(
    REACTIONS,
    """SELECT count(*) AS total_reaction_occurrences, count(DISTINCT reaction_pt) AS unique_reaction_terms
FROM reactions WHERE reaction_pt IS NOT NULL AND reaction_pt <> ''""",
)


def _top_terms(where: str, n: int = 10) -> str:
    return f"""SELECT * FROM (
  SELECT reaction_pt, n, row_number() OVER (ORDER BY n DESC, reaction_pt ASC) AS rank
  FROM (SELECT reaction_pt, count(*) AS n FROM reactions
        WHERE reaction_pt IS NOT NULL AND reaction_pt <> ''{where} GROUP BY reaction_pt)
) WHERE rank <= {n}"""


ORACLE["top_reactions"] = _sql(REACTIONS, _top_terms(""))
ORACLE["top_serious_reactions"] = _sql(
    REACTIONS, _top_terms(f" AND {inset('case_serious', REACTION_SERIOUS_VALUES)}")
)

ORACLE["cases_by_month"] = _sql(
    CASES,
    f"SELECT {month('report_date')} AS month, count(*) AS n FROM cases WHERE report_date IS NOT NULL GROUP BY 1",
)

ORACLE["reactions_by_month"] = _sql(
    REACTIONS,
    f"""SELECT {month('case_report_date')} AS month, count(*) AS n FROM reactions
WHERE case_report_date IS NOT NULL GROUP BY 1""",
)

ORACLE["case_trend_summary"] = _sql(
    CASES + ",",
    f"""m AS (SELECT {month('report_date')} AS month, count(*) AS n FROM cases
       WHERE report_date IS NOT NULL GROUP BY 1),
f AS (SELECT month, n FROM m ORDER BY month ASC LIMIT 1),
l AS (SELECT month, n FROM m ORDER BY month DESC LIMIT 1),
h AS (SELECT month, n FROM m ORDER BY n DESC, month ASC LIMIT 1),
lo AS (SELECT month, n FROM m ORDER BY n ASC, month ASC LIMIT 1)
SELECT h.month AS highest_month, h.n AS highest_month_count,
  lo.month AS lowest_month, lo.n AS lowest_month_count,
  f.month AS first_month, f.n AS first_month_count,
  l.month AS last_month, l.n AS last_month_count,
  l.n - f.n AS absolute_change,
  CASE WHEN f.n = 0 THEN NULL ELSE {pct('l.n - f.n', 'f.n')} END AS percentage_change
FROM h, lo, f, l""",
)

ORACLE["outcome_distribution"] = _sql(
    REACTIONS,
    f"SELECT {unknown_if_blank('reaction_outcome')} AS value, count(*) AS n FROM reactions GROUP BY 1",
)

_ALERT_COUNT = {
    "fulfillexpeditecriteria": "expedite_alert_cases",
    "seriousnessdeath": "death_count",
    "seriousnesslifethreatening": "life_threatening_count",
}
ORACLE["alert_rates"] = _sql(
    METRICS,
    " UNION ALL ".join(
        f"""SELECT '{alert}' AS alert, {i + 1} AS ord, {_ALERT_COUNT[col]} AS count,
  {pct(_ALERT_COUNT[col], 'total_unique_cases')} AS percentage, '{text}' AS interpretation FROM metrics"""
        for i, (alert, col, text) in enumerate(ALERT_INTERPRETATIONS)
    ),
)

ORACLE["reaction_concentration"] = _sql(
    REACTIONS + ",",
    f"""tot AS (SELECT count(*) AS total, count_if(case_report_date IS NOT NULL) AS dated FROM reactions),
c AS (SELECT reaction_pt, count(*) AS count FROM reactions WHERE reaction_pt IS NOT NULL GROUP BY 1),
top AS (SELECT reaction_pt, count, row_number() OVER (ORDER BY count DESC, reaction_pt ASC) AS rank FROM c)
SELECT reaction_pt, rank, count, {pct('count', 'total')} AS percentage_of_reactions
FROM top, tot WHERE rank <= 5 AND dated > 0""",
)

ORACLE["reaction_month_matrix"] = _sql(
    REACTIONS + ",",
    f"""cells AS (
  SELECT reaction_pt, CASE WHEN case_report_date IS NOT NULL THEN {month('case_report_date')} END AS month,
    count(*) AS n
  FROM reactions WHERE reaction_pt IS NOT NULL GROUP BY 1, 2
),
tt AS (SELECT reaction_pt, sum(n) AS t FROM cells GROUP BY 1),
top AS (SELECT reaction_pt, row_number() OVER (ORDER BY t DESC, reaction_pt ASC) AS rank FROM tt)
SELECT cells.reaction_pt, top.rank, cells.month, cells.n
FROM cells JOIN top ON cells.reaction_pt = top.reaction_pt
WHERE top.rank <= 5 AND cells.month IS NOT NULL""",
)

_FIXED = " UNION ALL ".join(
    "SELECT {o} AS k, '{s}' AS note".format(o=i + 10, s=s.replace("'", "''")) for i, s in enumerate(FIXED_LIMITATIONS)
)
ORACLE["missingness_notes"] = _sql(
    METRICS + ",",
    f"""notes AS (
  SELECT 1 AS k, CASE WHEN age_missing_cases > 0 THEN
    'Age was unavailable or could not be normalized for ' || age_missing_cases || ' cases.' END AS note FROM metrics
  UNION ALL SELECT 2, CASE WHEN missing_sex > 0 THEN 'Sex was missing for ' || missing_sex || ' cases.' END FROM metrics
  UNION ALL SELECT 3, CASE WHEN missing_dates > 0 THEN
    'Reporting date was unavailable for ' || missing_dates || ' cases.' END FROM metrics
  UNION ALL {_FIXED}
)
SELECT row_number() OVER (ORDER BY k) AS ord, note FROM notes WHERE note IS NOT NULL""",
)

ORACLE["reporting_period"] = _sql(
    METRICS,
    """SELECT start_d IS NOT NULL AS available, strftime(start_d, '%Y-%m-%d') AS start_date,
  strftime(end_d, '%Y-%m-%d') AS end_date,
  (year(end_d) * 12 + month(end_d)) - (year(start_d) * 12 + month(start_d)) + 1 AS number_of_months
FROM metrics""",
)


# --- F: grounding -----------------------------------------------------------------

# DuckDB has no look-behind: blank out a sign/digit that follows an ASCII
# letter, then match the rest of the pattern (same tokens as the original).
_NUM_RE = r"[-+]?\d{1,3}(?:,\d{3})*(?:\.\d+)?%?|[-+]?\d+(?:\.\d+)?%?"


def numbers(e: str) -> str:
    return f"regexp_extract_all(regexp_replace({e}, '([A-Za-z])[-+0-9]', '\\1 ', 'g'), '{_NUM_RE}')"


def numval(e: str) -> str:
    return f"try_cast(regexp_replace({e}, '[,%]', '', 'g') AS DOUBLE)"


DOC_NUMBERS = f"""
doc_nums AS (SELECT doc_id, lang, {numbers('text')} AS nums FROM documents),
text_numbers AS (
  SELECT doc_id, lang, unnest(generate_series(1, len(nums))) AS pos, unnest(nums) AS number FROM doc_nums
),
page_nums AS (
  SELECT regexp_extract(html, '<html lang="([A-Za-z-]+)"', 1) AS lang, unnest({numbers('html')}) AS n FROM pages
),
evidence AS (SELECT DISTINCT lang, {numval('n')} AS value FROM page_nums),
unsupported AS (
  SELECT t.doc_id, t.lang, t.pos, t.number, {numval('t.number')} AS value FROM text_numbers t
  WHERE NOT EXISTS (SELECT 1 FROM evidence e WHERE e.lang = t.lang AND e.value = {numval('t.number')})
)"""

_CHECK = list(FLAGGED_PHRASES) + ["license", "licensed", "all rights reserved", "apache", "mit"]
_PHRASES = ", ".join(f"({i + 1}, '{p}')" for i, p in enumerate(_CHECK))

FINDINGS = f"""
phrases(ord, phrase) AS (VALUES {_PHRASES}),
findings AS (
  SELECT doc_id, ord, phrase, 'Potentially unsupported claim: ''' || phrase || '''' AS finding
  FROM documents JOIN phrases ON contains(lower(text), phrase)
  WHERE text IS NOT NULL AND text <> ''
  UNION ALL
  SELECT doc_id, 0, NULL, 'Generated text is empty.' FROM documents WHERE text IS NULL OR text = ''
)"""

ORACLE["text_numbers"] = f"WITH {DOC_NUMBERS}\nSELECT doc_id, lang, pos, number, {numval('number')} AS value FROM text_numbers"
ORACLE["evidence_numbers"] = f"WITH {DOC_NUMBERS}\nSELECT lang, value FROM evidence"
ORACLE["unsupported_numbers"] = f"WITH {DOC_NUMBERS}\nSELECT doc_id, lang, pos, number, value FROM unsupported"
ORACLE["claim_phrases"] = f"WITH {FINDINGS}\nSELECT doc_id, ord, phrase, finding FROM findings"
ORACLE["section_validation"] = f"""WITH {DOC_NUMBERS}, {FINDINGS},
nb AS (SELECT doc_id, count(*) AS c FROM unsupported GROUP BY 1),
nc AS (SELECT doc_id, count(*) AS c FROM findings GROUP BY 1),
v AS (
  SELECT d.doc_id, coalesce(nb.c, 0) AS n_unsupported_numbers, coalesce(nc.c, 0) AS n_unsupported_claims,
    coalesce(nb.c, 0) = 0 AND coalesce(nc.c, 0) = 0 AND coalesce({strip('d.text')} <> '', false) AS valid
  FROM documents d LEFT JOIN nb ON d.doc_id = nb.doc_id LEFT JOIN nc ON d.doc_id = nc.doc_id
)
SELECT doc_id, n_unsupported_numbers, n_unsupported_claims, valid, NOT valid AS human_review_required FROM v"""


# --- A19: evidence facts, grouped by country, target filter on -------------------

RAW_G = RAW.replace(
    "  FROM core LEFT JOIN packed", "  , core.primarysourcecountry AS country\n  FROM core LEFT JOIN packed"
)

EVIDENCE_BASE = f"""WITH {RAW_G},
{_typed(CASE_COLS + PACKED_COLS + ['country'], 'raw', 'typed')},
latest AS (
  SELECT * FROM typed
  QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY safetyreportversion DESC) = 1
),
retained AS (
  SELECT * FROM latest
  WHERE coalesce(regexp_matches(upper(patient_drug_activesubstance_activesubstancename), '{TARGET}'), false)
),
{_cases_cte('retained', extra=', country')},
{_reactions_cte('retained', carry=['country'])},
{_drugs_cte('retained', carry=['country'])},
gm AS (
  SELECT country, count(*) AS total_unique_cases,
    count_if({SER_ANY}) AS serious_cases,
    count_if({NON}) AS non_serious_cases,
    count_if(NOT (({SER_ANY}) OR {NON})) AS unknown_seriousness,
    count_if({inset('fulfillexpeditecriteria', FLAG_VALUES)}) AS expedite_alert_cases,
    count_if({inset('seriousnessdeath', FLAG_VALUES)}) AS death_count,
    count_if({inset('seriousnesslifethreatening', FLAG_VALUES)}) AS life_threatening_count,
    count_if({inset('seriousnesshospitalization', FLAG_VALUES)}) AS hospitalization_count,
    count(age_years) AS age_available_cases,
    count_if(age_years IS NULL) AS age_missing_cases,
    round_even(min(age_years), 2) AS age_minimum_years,
    round_even(max(age_years), 2) AS age_maximum_years,
    round_even(avg(age_years), 2) AS age_mean_years,
    round_even(median(age_years), 2) AS age_median_years,
    count_if(patient_patientsex IS NULL) AS missing_sex,
    count_if(report_date IS NULL) AS missing_dates,
    min(report_date) AS start_d, max(report_date) AS end_d
  FROM cases GROUP BY country
),
cm AS (
  SELECT country, {month('report_date')} AS month, count(*) AS n FROM cases
  WHERE report_date IS NOT NULL GROUP BY 1, 2
),
cmr AS (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY month) AS r_first,
    row_number() OVER (PARTITION BY country ORDER BY month DESC) AS r_last,
    row_number() OVER (PARTITION BY country ORDER BY n DESC, month) AS r_high,
    row_number() OVER (PARTITION BY country ORDER BY n, month) AS r_low
  FROM cm
),
tr AS (
  SELECT country,
    max(CASE WHEN r_high = 1 THEN month END) AS high_m, max(CASE WHEN r_high = 1 THEN n END) AS high_n,
    max(CASE WHEN r_low = 1 THEN month END) AS low_m, max(CASE WHEN r_low = 1 THEN n END) AS low_n,
    max(CASE WHEN r_first = 1 THEN month END) AS first_m, max(CASE WHEN r_first = 1 THEN n END) AS first_n,
    max(CASE WHEN r_last = 1 THEN month END) AS last_m, max(CASE WHEN r_last = 1 THEN n END) AS last_n
  FROM cmr GROUP BY country
),
rm AS (
  SELECT country, {month('case_report_date')} AS month, count(*) AS n FROM reactions
  WHERE case_report_date IS NOT NULL GROUP BY 1, 2
),
rt AS (
  SELECT country, count(*) AS total_reaction_occurrences, count(DISTINCT reaction_pt) AS unique_reaction_terms
  FROM reactions WHERE reaction_pt IS NOT NULL AND reaction_pt <> '' GROUP BY country
),
rq AS (SELECT country, count(*) AS reaction_records, count_if(case_report_date IS NOT NULL) AS dated FROM reactions GROUP BY country),
dq AS (SELECT country, count(*) AS drug_records FROM drugs GROUP BY country),
g AS (
  SELECT gm.*, tr.*, coalesce(rt.total_reaction_occurrences, 0) AS total_reaction_occurrences,
    coalesce(rt.unique_reaction_terms, 0) AS unique_reaction_terms,
    coalesce(rq.reaction_records, 0) AS reaction_records, coalesce(rq.dated, 0) AS dated,
    coalesce(dq.drug_records, 0) AS drug_records
  FROM gm LEFT JOIN tr USING (country) LEFT JOIN rt USING (country)
    LEFT JOIN rq USING (country) LEFT JOIN dq USING (country)
),
vc AS (
  SELECT country, dimension, value, n,
    row_number() OVER (PARTITION BY country, dimension ORDER BY n DESC, value ASC) AS rank
  FROM (
    SELECT country, dimension, value, count(*) AS n FROM (
      SELECT country, 'age_group_distribution' AS dimension, {unknown_if_blank('age_group')} AS value FROM cases
      UNION ALL SELECT country, 'sex_distribution', {unknown_if_blank('patient_patientsex')} FROM cases
      UNION ALL SELECT country, 'primary_source_country', {unknown_if_blank('primarysourcecountry')} FROM cases
      UNION ALL SELECT country, 'occurrence_country', {unknown_if_blank('occurcountry')} FROM cases
      UNION ALL SELECT country, 'reaction_outcome_distribution', {unknown_if_blank('reaction_outcome')} FROM reactions
    ) GROUP BY 1, 2, 3
  )
),
tt AS (
  SELECT country, reaction_pt, n, row_number() OVER (PARTITION BY country ORDER BY n DESC, reaction_pt) AS rank
  FROM (SELECT country, reaction_pt, count(*) AS n FROM reactions
        WHERE reaction_pt IS NOT NULL AND reaction_pt <> '' GROUP BY 1, 2)
),
ts AS (
  SELECT country, reaction_pt, n, row_number() OVER (PARTITION BY country ORDER BY n DESC, reaction_pt) AS rank
  FROM (SELECT country, reaction_pt, count(*) AS n FROM reactions
        WHERE reaction_pt IS NOT NULL AND reaction_pt <> ''
          AND {inset('case_serious', REACTION_SERIOUS_VALUES)} GROUP BY 1, 2)
),
cc AS (
  SELECT c.country, c.reaction_pt, c.count, c.rank, {pct('c.count', 'rq.reaction_records')} AS pct
  FROM (SELECT country, reaction_pt, count,
          row_number() OVER (PARTITION BY country ORDER BY count DESC, reaction_pt) AS rank
        FROM (SELECT country, reaction_pt, count(*) AS count FROM reactions
              WHERE reaction_pt IS NOT NULL GROUP BY 1, 2)) c
  JOIN rq ON c.country = rq.country
  WHERE c.rank <= 5 AND rq.dated > 0
),
notes AS (
  SELECT country, row_number() OVER (PARTITION BY country ORDER BY k) AS ord, note FROM (
    SELECT country, 1 AS k, CASE WHEN age_missing_cases > 0 THEN
      'Age was unavailable or could not be normalized for ' || age_missing_cases || ' cases.' END AS note FROM gm
    UNION ALL SELECT country, 2, CASE WHEN missing_sex > 0 THEN
      'Sex was missing for ' || missing_sex || ' cases.' END FROM gm
    UNION ALL SELECT country, 3, CASE WHEN missing_dates > 0 THEN
      'Reporting date was unavailable for ' || missing_dates || ' cases.' END FROM gm
    UNION ALL SELECT country, k, note FROM gm, ({_FIXED}) fx
  ) WHERE note IS NOT NULL
)"""


def _leaf(section: str, path: str | None, kind: str, expr: str, src: str = "g") -> str:
    p = "NULL" if path is None else f"'{path}'"
    k = f"CASE WHEN ({expr}) IS NULL THEN 'null' ELSE '{kind}' END"
    if kind in ("int", "float"):
        num, s = f"CAST(({expr}) AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    elif kind == "bool":
        num, s = "CAST(NULL AS DOUBLE)", f"CASE WHEN ({expr}) THEN 'true' WHEN NOT ({expr}) THEN 'false' END"
    else:
        num, s = "CAST(NULL AS DOUBLE)", f"CAST(({expr}) AS VARCHAR)"
    return (
        f"SELECT country, '{section}' AS section, {p} AS path, CAST(NULL AS VARCHAR) AS key, 0 AS ord, "
        f"{k} AS kind, {num} AS value_num, {s} AS value_str FROM {src}"
    )


def _coll(section: str, path: str | None, src: str, key: str, ord_: str, kind: str, val: str, where: str = "") -> str:
    p = "NULL" if path is None else f"'{path}'"
    if kind in ("int", "float"):
        num, s = f"CAST({val} AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    else:
        num, s = "CAST(NULL AS DOUBLE)", f"CAST({val} AS VARCHAR)"
    w = f" WHERE {where}" if where else ""
    return (
        f"SELECT country, '{section}', {p}, {key}, {ord_}, CASE WHEN {val} IS NULL THEN 'null' ELSE '{kind}' END, "
        f"{num}, {s} FROM {src}{w}"
    )


_LABEL = "Widget"
_SCALARS = [
    ("metadata", "analysis_type", "str", "'Deterministic ICSR safety analysis'"),
    ("metadata", "target_product", "str", f"'{_LABEL}'"),
    ("metadata", "source", "str", f"'{_LABEL} ICSR dataset'"),
    ("metadata", "analysis_principle", "str", "'Python-calculated facts are the source of truth.'"),
    ("reporting_period", "available", "bool", "start_d IS NOT NULL"),
    ("reporting_period", "start_date", "str", "strftime(start_d, '%Y-%m-%d')"),
    ("reporting_period", "end_date", "str", "strftime(end_d, '%Y-%m-%d')"),
    ("reporting_period", "number_of_months", "int",
     "(year(end_d) * 12 + month(end_d)) - (year(start_d) * 12 + month(start_d)) + 1"),
    ("case_summary", "total_unique_cases", "int", "total_unique_cases"),
    ("case_summary", "serious_cases", "int", "serious_cases"),
    ("case_summary", "non_serious_cases", "int", "non_serious_cases"),
    ("case_summary", "unknown_seriousness", "int", "unknown_seriousness"),
    ("case_summary", "serious_percentage", "float", pct("serious_cases", "total_unique_cases")),
    ("case_summary", "non_serious_percentage", "float", pct("non_serious_cases", "total_unique_cases")),
    ("case_summary", "expedite_alert_cases", "int", "expedite_alert_cases"),
    ("case_summary", "expedite_alert_percentage", "float", pct("expedite_alert_cases", "total_unique_cases")),
]
for _name, _present in (("death", True), ("life_threatening", True), ("hospitalization", True),
                        ("disability", False), ("congenital_anomaly", False), ("other_serious", False)):
    _SCALARS += [
        ("seriousness", f"{_name}.available", "bool", "true" if _present else "false"),
        ("seriousness", f"{_name}.count", "int", f"{_name}_count" if _present else "NULL"),
        ("seriousness", f"{_name}.percentage", "float",
         pct(f"{_name}_count", "total_unique_cases") if _present else "NULL"),
    ]
_SCALARS += [
    ("demographics", "age.available_cases", "int", "age_available_cases"),
    ("demographics", "age.missing_cases", "int", "age_missing_cases"),
    ("demographics", "age.minimum_years", "float", "age_minimum_years"),
    ("demographics", "age.maximum_years", "float", "age_maximum_years"),
    ("demographics", "age.mean_years", "float", "age_mean_years"),
    ("demographics", "age.median_years", "float", "age_median_years"),
    ("reactions", "total_reaction_occurrences", "int", "total_reaction_occurrences"),
    ("reactions", "unique_reaction_terms", "int", "unique_reaction_terms"),
    ("outcomes", "available", "bool", "reaction_records > 0"),
    ("trends", "case_trends.highest_month.month", "str", "high_m"),
    ("trends", "case_trends.highest_month.count", "int", "high_n"),
    ("trends", "case_trends.lowest_month.month", "str", "low_m"),
    ("trends", "case_trends.lowest_month.count", "int", "low_n"),
    ("trends", "case_trends.first_month.month", "str", "first_m"),
    ("trends", "case_trends.first_month.count", "int", "first_n"),
    ("trends", "case_trends.last_month.month", "str", "last_m"),
    ("trends", "case_trends.last_month.count", "int", "last_n"),
    ("trends", "case_trends.absolute_change", "int", "last_n - first_n"),
    ("trends", "case_trends.percentage_change", "float",
     f"CASE WHEN first_n = 0 THEN NULL ELSE {pct('last_n - first_n', 'first_n')} END"),
]
_ALERT_SQL = {
    "expedite_cases": "expedite_alert_cases",
    "death_cases": "death_count",
    "life_threatening_cases": "life_threatening_count",
}
for _alert, _col, _text in ALERT_INTERPRETATIONS:
    _c = _ALERT_SQL[_alert]
    _SCALARS += [
        ("alerts", f"{_alert}.count", "int", _c),
        ("alerts", f"{_alert}.percentage", "float", pct(_c, "total_unique_cases")),
        ("alerts", f"{_alert}.interpretation", "str", "'" + _text.replace("'", "''") + "'"),
    ]
_SCALARS += [
    ("data_quality", "cases", "int", "total_unique_cases"),
    ("data_quality", "reaction_records", "int", "reaction_records"),
    ("data_quality", "drug_records", "int", "drug_records"),
]

_MONTH_ORD = "row_number() OVER (PARTITION BY country ORDER BY month)"
_COLLECTIONS = [
    _coll("case_summary", "cases_by_month", "cm", "month", _MONTH_ORD, "int", "n"),
    _coll("trends", "case_trends.monthly_case_counts", "cm", "month", _MONTH_ORD, "int", "n"),
    *[
        _coll("demographics", d, "vc", "value", "rank", "int", "n", f"dimension = '{d}'"
              + (" AND rank <= 10" if "country" in d else ""))
        for d in ("age_group_distribution", "sex_distribution", "primary_source_country", "occurrence_country")
    ],
    _coll("reactions", "most_frequent_reactions", "tt", "reaction_pt", "rank", "int", "n", "rank <= 10"),
    _coll("reactions", "most_frequent_serious_reactions", "ts", "reaction_pt", "rank", "int", "n", "rank <= 10"),
    _coll("reactions", "frequency_by_month", "rm", "month", _MONTH_ORD, "int", "n"),
    _coll("trends", "reaction_trends", "rm", "month", _MONTH_ORD, "int", "n"),
    _coll("reactions", "reaction_concentrations.count", "cc", "reaction_pt", "rank", "int", "count"),
    _coll("reactions", "reaction_concentrations.percentage_of_reactions", "cc", "reaction_pt", "rank", "float", "pct"),
    _coll("outcomes", "reaction_outcome_distribution", "vc", "value", "rank", "int", "n",
          "dimension = 'reaction_outcome_distribution'"),
    _coll("data_quality", "missingness_notes", "notes", "CAST(NULL AS VARCHAR)", "ord", "str", "note"),
    _coll("limitations", None, "notes", "CAST(NULL AS VARCHAR)", "ord", "str", "note"),
]

EVIDENCE_FACTS = EVIDENCE_BASE + ",\nfacts AS (\n" + "\nUNION ALL ".join(
    [_leaf(*s) for s in _SCALARS] + _COLLECTIONS
) + "\n)"

ORACLE["evidence_facts"] = EVIDENCE_FACTS + "\nSELECT * FROM facts"


# --- S4: evidence JSON, the same nested document built from the CTEs above ------
# DuckDB's to_json writes structs, ordered maps, lists, nulls and doubles below
# 1e7 exactly like Spark's to_json with ignoreNullFields=false.

_EMPTY = "MAP {}::MAP(VARCHAR, BIGINT)"
_EMPTY_CONC = "MAP {}::MAP(VARCHAR, STRUCT(\"count\" BIGINT, percentage_of_reactions DOUBLE))"


def _entries(key: str, val: str, order: str) -> str:
    return f"map_from_entries(list({{'k': {key}, 'v': {val}}} ORDER BY {order}))"


def _month_struct(m: str, n: str) -> str:
    return f"CASE WHEN {m} IS NOT NULL THEN {{'month': {m}, 'count': {n}}} END"


def _vc_map(dim: str, top: bool = False) -> str:
    cond = f"dimension = '{dim}'" + (" AND rank <= 10" if top else "")
    return f"map_from_entries(list({{'k': value, 'v': n}} ORDER BY rank) FILTER (WHERE {cond}))"


_SER_SQL = "".join(
    f"'{name}': {{'available': true, 'count': {name}_count, 'percentage': {pct(f'{name}_count', 'total_unique_cases')}}}, "
    for name in ("death", "life_threatening", "hospitalization")
) + ", ".join(
    f"'{name}': {{'available': false, 'count': NULL::BIGINT, 'percentage': NULL::DOUBLE}}"
    for name in ("disability", "congenital_anomaly", "other_serious")
)
_ALERTS_SQL = ", ".join(
    f"'{alert}': {{'count': {_ALERT_SQL[alert]}, 'percentage': {pct(_ALERT_SQL[alert], 'total_unique_cases')}, "
    f"'interpretation': '{text}'}}"
    for alert, _col, text in ALERT_INTERPRETATIONS
)
_META = {path: expr for section, path, _kind, expr in _SCALARS if section == "metadata"}

EVIDENCE_DOC = EVIDENCE_BASE + f""",
cmap AS (SELECT country, {_entries('month', 'n', 'month')} AS m FROM cm GROUP BY country),
rmap AS (SELECT country, {_entries('month', 'n', 'month')} AS m FROM rm GROUP BY country),
vmap AS (
  SELECT country,
    {_vc_map('age_group_distribution')} AS age_m,
    {_vc_map('sex_distribution')} AS sex_m,
    {_vc_map('primary_source_country', True)} AS psc_m,
    {_vc_map('occurrence_country', True)} AS occ_m,
    {_vc_map('reaction_outcome_distribution')} AS out_m
  FROM vc GROUP BY country
),
tmap AS (SELECT country, {_entries('reaction_pt', 'n', 'rank')} AS m FROM tt WHERE rank <= 10 GROUP BY country),
smap AS (SELECT country, {_entries('reaction_pt', 'n', 'rank')} AS m FROM ts WHERE rank <= 10 GROUP BY country),
ccmap AS (
  SELECT country, {_entries('reaction_pt', "{'count': count, 'percentage_of_reactions': pct}", 'rank')} AS m
  FROM cc GROUP BY country
),
nlist AS (SELECT country, list(note ORDER BY ord) AS notes FROM notes GROUP BY country),
doc AS (
  SELECT g.*, cmap.m AS cbm, rmap.m AS rbm, vmap.age_m, vmap.sex_m, vmap.psc_m, vmap.occ_m, vmap.out_m,
    tmap.m AS top_m, smap.m AS ser_m, ccmap.m AS conc_m, nlist.notes
  FROM g
  LEFT JOIN cmap ON cmap.country = g.country LEFT JOIN rmap ON rmap.country = g.country
  LEFT JOIN vmap ON vmap.country = g.country LEFT JOIN tmap ON tmap.country = g.country
  LEFT JOIN smap ON smap.country = g.country LEFT JOIN ccmap ON ccmap.country = g.country
  LEFT JOIN nlist ON nlist.country = g.country
),
evdoc AS (SELECT country, {{
  'metadata': {{'analysis_type': {_META['analysis_type']}, 'target_product': {_META['target_product']},
    'source': {_META['source']}, 'analysis_principle': {_META['analysis_principle']}}},
  'reporting_period': {{'available': start_d IS NOT NULL, 'start_date': strftime(start_d, '%Y-%m-%d'),
    'end_date': strftime(end_d, '%Y-%m-%d'),
    'number_of_months': (year(end_d) * 12 + month(end_d)) - (year(start_d) * 12 + month(start_d)) + 1}},
  'case_summary': {{'total_unique_cases': total_unique_cases, 'serious_cases': serious_cases,
    'non_serious_cases': non_serious_cases, 'unknown_seriousness': unknown_seriousness,
    'serious_percentage': {pct('serious_cases', 'total_unique_cases')},
    'non_serious_percentage': {pct('non_serious_cases', 'total_unique_cases')},
    'expedite_alert_cases': expedite_alert_cases,
    'expedite_alert_percentage': {pct('expedite_alert_cases', 'total_unique_cases')},
    'cases_by_month': coalesce(cbm, {_EMPTY})}},
  'seriousness': {{{_SER_SQL}}},
  'demographics': {{'age': {{'available_cases': age_available_cases, 'missing_cases': age_missing_cases,
      'minimum_years': age_minimum_years, 'maximum_years': age_maximum_years,
      'mean_years': age_mean_years, 'median_years': age_median_years}},
    'age_group_distribution': coalesce(age_m, {_EMPTY}), 'sex_distribution': coalesce(sex_m, {_EMPTY}),
    'primary_source_country': coalesce(psc_m, {_EMPTY}), 'occurrence_country': coalesce(occ_m, {_EMPTY})}},
  'reactions': {{'total_reaction_occurrences': total_reaction_occurrences,
    'unique_reaction_terms': unique_reaction_terms,
    'most_frequent_reactions': coalesce(top_m, {_EMPTY}),
    'most_frequent_serious_reactions': coalesce(ser_m, {_EMPTY}),
    'frequency_by_month': coalesce(rbm, {_EMPTY}),
    'reaction_concentrations': coalesce(conc_m, {_EMPTY_CONC})}},
  'outcomes': {{'available': reaction_records > 0,
    'reaction_outcome_distribution': CASE WHEN reaction_records > 0 THEN coalesce(out_m, {_EMPTY}) END}},
  'trends': {{'case_trends': {{'monthly_case_counts': coalesce(cbm, {_EMPTY}),
      'highest_month': {_month_struct('high_m', 'high_n')}, 'lowest_month': {_month_struct('low_m', 'low_n')},
      'first_month': {_month_struct('first_m', 'first_n')}, 'last_month': {_month_struct('last_m', 'last_n')},
      'absolute_change': last_n - first_n,
      'percentage_change': CASE WHEN first_n = 0 THEN NULL ELSE {pct('last_n - first_n', 'first_n')} END}},
    'reaction_trends': coalesce(rbm, {_EMPTY})}},
  'alerts': {{{_ALERTS_SQL}}},
  'data_quality': {{'cases': total_unique_cases, 'reaction_records': reaction_records,
    'drug_records': drug_records, 'missingness_notes': notes}},
  'limitations': notes
}} AS ev FROM doc)"""

ORACLE["evidence_json"] = EVIDENCE_DOC + "\nSELECT country, to_json(ev) AS evidence_json FROM evdoc"


# --- E1 / G: section slices and deterministic report sections -----------------

from casewatch.config import (  # noqa: E402
    DEFAULT_MODEL_NAME,
    METHODOLOGY_TEXT,
    SECTION_MAP,
    TRACEABILITY_TEXT,
)


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_SECTION_ROWS = ", ".join(
    f"('{name}', '{key}')" for name, keys in SECTION_MAP for key in keys
)
ORACLE["section_evidence"] = (
    EVIDENCE_FACTS
    + f""",
smap(report_section, section) AS (VALUES {_SECTION_ROWS})
SELECT f.country, m.report_section, f.section, f.path, f.key, f.ord, f.kind, f.value_num, f.value_str
FROM facts f JOIN smap m ON f.section = m.section"""
)

_PERIOD = """CASE WHEN start_d IS NULL THEN 'Reporting period information was not available in the supplied dataset.'
  ELSE 'The available reporting period extends from ' || strftime(start_d, '%Y-%m-%d') || ' to '
    || strftime(end_d, '%Y-%m-%d') || ', covering '
    || CAST((year(end_d) * 12 + month(end_d)) - (year(start_d) * 12 + month(start_d)) + 1 AS VARCHAR)
    || ' month(s).' END"""
_CASE = """'A total of ' || format('{:,}', total_unique_cases) || ' unique cases were identified. Of these, '
  || format('{:,}', serious_cases) || ' were classified as serious and ' || format('{:,}', non_serious_cases)
  || ' as non-serious. ' || format('{:,}', expedite_alert_cases) || ' cases met the supplied expedite/alert criterion.'"""
ORACLE["report_sections"] = (
    EVIDENCE_FACTS
    + f""",
lim AS (SELECT country, string_agg('- ' || note, chr(10) ORDER BY ord) AS body FROM notes GROUP BY country)
SELECT country, 1 AS section_no, 'Reporting Period' AS title, {_PERIOD} AS body FROM g
UNION ALL SELECT country, 3, 'Case Summary', {_CASE} FROM g
UNION ALL SELECT country, 8, 'Methodology', {_sq(METHODOLOGY_TEXT % DEFAULT_MODEL_NAME)} FROM g
UNION ALL SELECT country, 9, 'Limitations', body FROM lim
UNION ALL SELECT country, 11, 'Evidence Traceability', {_sq(TRACEABILITY_TEXT)} FROM g"""
)


# --- E2-E6: compacted section evidence, prompts and fallback text ---------------
from casewatch.config import (  # noqa: E402
    GROUNDING_RULES,
    PROMPT_CLOSING,
    SECTION_INSTRUCTIONS,
    SECTION_MAP,
    SECTION_TITLES,
)

_TREND_KEYS = ("highest_month", "lowest_month", "first_month", "last_month", "absolute_change", "percentage_change")
_MEDICAL = ("hospitalization", "disability", "congenital_anomaly", "other_serious")


def _compact_sql(section: str) -> str:
    """The section's compacted evidence as a DuckDB struct over ``ev``; keys
    outside the section's slice read as NULL."""
    has = set(dict(SECTION_MAP)[section])

    def get(k: str, path: str = "") -> str:
        return f"ev.{k}{path}" if k in has else "NULL"

    def rate(k: str) -> str:
        c = get("seriousness", f".{k}")
        return f"CASE WHEN {c} IS NULL THEN NULL ELSE {{'count': {c}.count, 'percentage': {c}.percentage}} END"

    def fields(pairs) -> str:
        return "{" + ", ".join(f"'{name}': {expr}" for name, expr in pairs) + "}"

    rp = get("reporting_period")
    period = fields([(k, get("reporting_period", f".{k}")) for k in ("start_date", "end_date", "number_of_months")])
    oc = get("outcomes")
    outcomes = (f"CASE WHEN {oc} IS NOT NULL THEN "
                f"{{'reaction_outcome_distribution': {get('outcomes', '.reaction_outcome_distribution')}}} END")
    trend = fields([(k, get("trends", f".case_trends.{k}")) for k in _TREND_KEYS])
    cs = lambda k: get("case_summary", f".{k}")
    rx = lambda k: get("reactions", f".{k}")
    if section == "narrative_summary":
        return fields([
            ("reporting_period", f"CASE WHEN {rp} IS NOT NULL THEN {period} END"),
            ("case_summary", fields([
                ("total_cases", cs("total_unique_cases")), ("serious_cases", cs("serious_cases")),
                ("non_serious_cases", cs("non_serious_cases")), ("serious_percentage", cs("serious_percentage")),
                ("expedite_cases", cs("expedite_alert_cases")),
                ("expedite_percentage", cs("expedite_alert_percentage"))])),
            ("seriousness", fields([("death", rate("death")), ("life_threatening", rate("life_threatening")),
                                    ("medical_event", fields([(k, rate(k)) for k in _MEDICAL]))])),
            ("demographics", fields([
                ("age", fields([("groups", get("demographics", ".age_group_distribution"))])),
                ("sex", get("demographics", ".sex_distribution"))])),
            ("reactions", fields([("total", rx("total_reaction_occurrences")), ("top", rx("most_frequent_reactions"))])),
            ("outcomes", outcomes),
            ("alerts", get("alerts")),
        ])
    if section == "summary_analysis":
        return fields([
            ("cases", fields([(k, cs(k)) for k in (
                "total_unique_cases", "serious_cases", "non_serious_cases", "serious_percentage",
                "expedite_alert_cases", "expedite_alert_percentage")])),
            ("seriousness", fields([("death", rate("death")), ("life_threatening", rate("life_threatening")),
                                    ("other_serious", fields([(k, rate(k)) for k in _MEDICAL]))])),
            ("demographics", fields([("age_groups", get("demographics", ".age_group_distribution")),
                                     ("sex", get("demographics", ".sex_distribution"))])),
            ("reactions", fields([("total", rx("total_reaction_occurrences")), ("top", rx("most_frequent_reactions"))])),
            ("outcomes", outcomes),
            ("trends", trend),
        ])
    if section == "reaction_analysis":
        top, conc = rx("most_frequent_reactions"), rx("reaction_concentrations")
        picked = (f"map_from_entries(list_filter(list_transform(map_keys({top})[1:5], "
                  f"lambda k: {{'k': k, 'v': {conc}[k]}}), lambda e: e.v IS NOT NULL))")
        return fields([
            ("total_reaction_occurrences", rx("total_reaction_occurrences")),
            ("unique_reaction_terms", rx("unique_reaction_terms")),
            ("most_frequent_reactions", top),
            ("most_frequent_serious_reactions", rx("most_frequent_serious_reactions")),
            ("reaction_concentrations", picked),
        ])
    if section == "serious_alert_analysis":
        return fields([
            ("case_summary", fields([(k, cs(k)) for k in (
                "total_unique_cases", "serious_cases", "non_serious_cases", "unknown_seriousness",
                "serious_percentage", "expedite_alert_cases", "expedite_alert_percentage")])),
            ("seriousness", fields([(k, rate(k)) for k in ("death", "life_threatening", *_MEDICAL)])),
            ("alerts", get("alerts")),
            ("outcomes", outcomes),
        ])
    return fields([("reporting_period", period), ("case_trend_summary", trend)])


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _prompt_prefix(section: str) -> str:
    return ("\n" + GROUNDING_RULES + "\n\nSECTION:\n" + dict(SECTION_TITLES)[section] + "\n\nTASK:\n"
            + dict(SECTION_INSTRUCTIONS)[section] + "\n\nEVIDENCE:\n").lstrip()


_SECTION_ROWS_SQL = "\nUNION ALL ".join(
    f"SELECT country, {i + 1} AS section_ord, '{name}' AS report_section, to_json({_compact_sql(name)}) AS compact "
    f"FROM evdoc"
    for i, (name, _keys) in enumerate(SECTION_MAP)
)
SECTION_PROMPTS = EVIDENCE_DOC + f""",
compacted AS (
{_SECTION_ROWS_SQL}
),
prompts AS (
  SELECT country, section_ord, report_section, compact,
    CASE section_ord {" ".join(f"WHEN {i + 1} THEN {_lit(_prompt_prefix(name))}" for i, (name, _k) in enumerate(SECTION_MAP))} END
      || compact || {_lit(chr(10) + chr(10) + PROMPT_CLOSING)} AS prompt
  FROM compacted
)"""

ORACLE["section_prompt"] = SECTION_PROMPTS + "\nSELECT country, section_ord, report_section, prompt FROM prompts"

# Python json.dumps spacing: a space after every ',' and ':' outside strings.
_JSON_TOKEN_SQL = '("(?:[^"\\\\]|\\\\.)*")|([,:])'
ORACLE["fallback_text"] = SECTION_PROMPTS + f"""
SELECT country, report_section,
  replace(replace(regexp_replace(compact, '{_JSON_TOKEN_SQL}', '\\1\\2' || chr(1), 'g'), '"' || chr(1), '"'), chr(1), ' ')
    AS text
FROM prompts"""


# --- F4-F6 on the section texts, G5-G6: the report document ----------------------
from casewatch.config import (  # noqa: E402
    NO_LIMITATIONS_TEXT,
    REPORT_HEADINGS,
    REPORT_TITLE,
    REVIEW_CHECKLIST,
    REVIEW_LIST_INTRO,
    REVIEW_PASSED,
    REVIEW_PENDING,
)

_FACTS_CTE = EVIDENCE_FACTS[len(EVIDENCE_BASE):]  # ",\nfacts AS (...)"
_SECTION_PHRASES = "[" + ", ".join(_sq(p) for p in FLAGGED_PHRASES) + "]"
_NL2 = "chr(10) || chr(10)"

REPORT_BASE = SECTION_PROMPTS + _FACTS_CTE + f""",
secmap(report_section, section) AS (VALUES {_SECTION_ROWS}),
sec_nums AS (
  SELECT f.country, m.report_section, f.value_num AS value
  FROM facts f JOIN secmap m ON f.section = m.section WHERE f.kind IN ('int', 'float')
  UNION
  SELECT country, report_section, {numval('n')} FROM (
    SELECT f.country, m.report_section, unnest({numbers('f.value_str')}) AS n
    FROM facts f JOIN secmap m ON f.section = m.section WHERE f.kind = 'str')
),
ev_nums AS (SELECT country, report_section, list(value) AS nums FROM sec_nums GROUP BY 1, 2),
texts AS (
  SELECT country, section_ord, report_section,
    replace(replace(regexp_replace(compact, '{_JSON_TOKEN_SQL}', '\\1\\2' || chr(1), 'g'), '"' || chr(1), '"'),
      chr(1), ' ') AS text
  FROM prompts
),
checked AS (
  SELECT t.*, len(list_filter({numbers('t.text')},
      lambda x: NOT coalesce(list_contains(coalesce(e.nums, []), {numval('x')}), false))) AS n_bad,
    CASE WHEN t.text IS NULL OR t.text = '' THEN 1
      ELSE len(list_filter({_SECTION_PHRASES}, lambda p: contains(lower(t.text), p))) END AS n_claims
  FROM texts t LEFT JOIN ev_nums e ON e.country = t.country AND e.report_section = t.report_section
),
per_group AS (
  SELECT country,
    {", ".join(f"max(CASE WHEN report_section = '{name}' THEN text END) AS t_{name}" for name, _k in SECTION_MAP)},
    string_agg('- ' || report_section, chr(10) ORDER BY section_ord)
      FILTER (WHERE NOT (n_bad = 0 AND n_claims = 0 AND trim(text) <> '')) AS failing
  FROM checked GROUP BY country
),
lim AS (SELECT country, string_agg('- ' || note, chr(10) ORDER BY ord) AS body FROM notes GROUP BY country)"""

_REVIEW = (f"{_sq(REVIEW_PENDING)} || {_NL2} || CASE WHEN p.failing IS NULL THEN {_sq(REVIEW_PASSED)} "
           f"ELSE {_sq(REVIEW_LIST_INTRO)} || {_NL2} || p.failing END || {_NL2} || {_sq(REVIEW_CHECKLIST)}")
_BODIES = [
    _PERIOD,
    "p.t_narrative_summary",
    _CASE,
    "p.t_summary_analysis",
    "p.t_reaction_analysis",
    "p.t_serious_alert_analysis",
    "p.t_trend_interpretation",
    _sq(METHODOLOGY_TEXT % DEFAULT_MODEL_NAME),
    f"coalesce(lim.body, {_sq(NO_LIMITATIONS_TEXT)})",
    _REVIEW,
    _sq(TRACEABILITY_TEXT),
]
_DOC_PARTS = " || ".join(
    f"{_sq('## ' + h)} || {_NL2} || coalesce({b}, '')" + (f" || {_sq(chr(10) * 2 + '---' + chr(10) * 2)}" if i < 10 else "")
    for i, (h, b) in enumerate(zip(REPORT_HEADINGS, _BODIES))
)
ORACLE["report_document"] = REPORT_BASE + f"""
SELECT g.country, trim({_sq(REPORT_TITLE)} || {_NL2} || {_DOC_PARTS}) AS report
FROM g LEFT JOIN per_group p ON p.country = g.country LEFT JOIN lim ON lim.country = g.country"""


# --- E7: the audit record ---------------------------------------------------------
from casewatch.config import (  # noqa: E402
    CLAIM_MESSAGE_PREFIX,
    EMPTY_TEXT_FINDING,
    FALLBACK_MODEL,
)

_SLICES = " ".join(
    "WHEN {} THEN to_json({{{}}})".format(i + 1, ", ".join(f"'{k}': ev.{k}" for k in keys))
    for i, (_name, keys) in enumerate(SECTION_MAP)
)
ORACLE["generation_audit"] = REPORT_BASE + f""",
found AS (
  SELECT t.*,
    list_filter({numbers('t.text')},
      lambda x: NOT coalesce(list_contains(coalesce(e.nums, []), {numval('x')}), false)) AS bad,
    CASE WHEN t.text IS NULL OR t.text = '' THEN [{_sq(EMPTY_TEXT_FINDING)}]
      ELSE list_transform(list_filter({_SECTION_PHRASES}, lambda p: contains(lower(t.text), p)),
        lambda p: {_sq(CLAIM_MESSAGE_PREFIX)} || p || chr(39)) END AS claims
  FROM texts t LEFT JOIN ev_nums e ON e.country = t.country AND e.report_section = t.report_section
),
judged AS (SELECT *, len(bad) = 0 AND len(claims) = 0 AND trim(text) <> '' AS ok FROM found)
SELECT j.country, j.section_ord, j.report_section AS section,
  CASE j.section_ord {_SLICES} END AS evidence, p.prompt, j.text,
  to_json({{'valid': j.ok, 'unsupported_numbers': j.bad, 'unsupported_claims': j.claims,
    'human_review_required': NOT j.ok}}) AS validation,
  true AS mock_llm, {_sq(FALLBACK_MODEL)} AS model
FROM judged j JOIN evdoc d ON d.country = j.country
  JOIN prompts p ON p.country = j.country AND p.section_ord = j.section_ord"""


# --- a group key that is null on purpose: the twin runs on a stand-in value --------
def _null_group(sql: str) -> str:
    keyed = sql.replace(
        "core.primarysourcecountry AS country",
        "coalesce(CASE WHEN core.reporttype <> 'P' THEN core.primarysourcecountry END, '<none>') AS country",
    )
    return f"SELECT * REPLACE (nullif(country, '<none>') AS country) FROM ({keyed})"


ORACLE["evidence_facts_null_group"] = _null_group(ORACLE["evidence_facts"])
ORACLE["report_document_null_group"] = _null_group(ORACLE["report_document"])


# -- quantiles and distinct terms, also from stored sketches ----------------------

_CASES_COUNTRY = f"""WITH {CORE},
{_typed(CASE_COLS, 'core', 'typed')},
{_cases_cte('typed', extra=', primarysourcecountry AS country')}"""


def _quantile(p: float) -> str:
    at = f"((n - 1) * {p}::DOUBLE)"
    value = lambda r: f"max(CASE WHEN rn = {r} THEN age_years END)"
    low, high = value(f"floor({at})"), value(f"ceil({at})")
    return (
        f"round_even(CASE WHEN max(floor({at})) = max(ceil({at})) THEN {low} "
        f"ELSE max(ceil({at}) - {at}) * {low} + max({at} - floor({at})) * {high} END, 2)"
    )


ORACLE["age_quantiles"] = _sql(
    _CASES_COUNTRY,
    f"""SELECT country, max(n) AS n, {_quantile(0.25)} AS q1, {_quantile(0.5)} AS median, {_quantile(0.75)} AS q3
FROM (SELECT country, age_years, count(*) OVER (PARTITION BY country) AS n,
        row_number() OVER (PARTITION BY country ORDER BY age_years) - 1 AS rn
      FROM cases WHERE age_years IS NOT NULL)
GROUP BY country""",
)

ORACLE["age_sketch_quantiles"] = _sql(
    _CASES_COUNTRY,
    """SELECT country, count(*) AS n, true AS q1_kept, true AS median_kept, true AS q3_kept
FROM cases WHERE age_years IS NOT NULL GROUP BY country""",
)

ORACLE["reaction_term_sketches"] = _sql(
    REACTIONS + ",",
    """named AS (
  SELECT t.primarysourcecountry AS country, r.reaction_pt
  FROM reactions r JOIN typed t ON r.safetyreportid = t.safetyreportid
  WHERE r.reaction_pt IS NOT NULL AND r.reaction_pt <> ''
)
SELECT country, count(*) AS total_reaction_occurrences, count(DISTINCT reaction_pt) AS exact_terms, true AS kept
FROM named GROUP BY country
UNION ALL SELECT '*', count(*), count(DISTINCT reaction_pt), true FROM named""",
)


# -- S1: lines into rows and violations ------------------------------------------

_LINE_CELLS = f"""WITH {CORE},
cells AS (
  SELECT o_orderkey, safetyreportid, serious, primarysourcecountry, report_date,
    CASE o_orderkey % 3 WHEN 0 THEN 'see "' || serious || '", then ' || reporttype WHEN 1 THEN 'plain' END AS remark
  FROM core
)"""

ORACLE["csv_quarantine"] = _sql(
    _LINE_CELLS + ",",
    """texts AS (
  SELECT *, 'part-' || (o_orderkey % 4) AS source_file,
    [safetyreportid, coalesce(serious, ''), coalesce(primarysourcecountry, ''), coalesce(report_date, ''),
     CASE WHEN remark IS NULL THEN '' WHEN o_orderkey % 3 = 0 THEN '"' || replace(remark, '"', '""') || '"' ELSE remark END] AS t
  FROM cells
), whole AS (
  SELECT *, array_to_string(CASE WHEN o_orderkey % 4 = 2 THEN list_reverse(t) ELSE t END, ',') AS full_line FROM texts
), told AS (
  SELECT *,
    CASE WHEN o_orderkey % 19 = 0 THEN array_to_string(string_split(full_line, ',')[1:3], ',')
         WHEN o_orderkey % 23 = 0 THEN full_line || ',more'
         WHEN o_orderkey % 29 = 0 THEN full_line || ',"open' ELSE full_line END AS line
  FROM whole
), judged AS (
  SELECT *,
    CASE WHEN o_orderkey % 4 = 3 THEN 'the file has no header with the required columns'
         WHEN (length(line) - length(replace(line, '"', ''))) % 2 = 1 THEN 'quotes do not match'
         WHEN o_orderkey % 19 = 0 OR o_orderkey % 23 = 0 THEN 'the number of cells differs from the header''s' END AS reason
  FROM told
)
SELECT source_file, safetyreportid, serious, primarysourcecountry, report_date, remark, NULL AS reason, NULL AS line
FROM judged WHERE reason IS NULL
UNION ALL SELECT source_file, NULL, NULL, NULL, NULL, NULL, reason, line FROM judged WHERE reason IS NOT NULL""",
)

ORACLE["json_quarantine"] = _sql(
    _LINE_CELLS,
    """SELECT 'lines' AS source_file, safetyreportid, CASE WHEN o_orderkey % 29 = 0 THEN 'twice' ELSE serious END AS serious,
  primarysourcecountry, report_date, remark,
  coalesce(serious, '') || ',x' AS codes, '{"a":1}' AS nested, NULL AS reason, NULL::BIGINT AS n_lines
FROM cells WHERE o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0 AND (o_orderkey % 29 <> 0 OR serious IS NULL)
UNION ALL
SELECT 'lines', NULL, NULL, NULL, NULL, NULL, NULL, NULL, reason, count(*) FROM (
  SELECT CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 23 = 0 THEN 'not a complete JSON object'
              WHEN o_orderkey % 29 = 0 AND serious IS NOT NULL THEN 'a column name is repeated' END AS reason
  FROM cells) WHERE reason IS NOT NULL GROUP BY reason""",
)


# -- documents of any shape, limitations from outside, prompts by request ------------

ORACLE["document_numbers"] = f"""
SELECT DISTINCT country, value FROM (
  SELECT country, value_num AS value FROM ({ORACLE["evidence_facts"]}) WHERE kind IN ('int', 'float')
  UNION ALL
  SELECT country, {numval('n')} AS value
  FROM (SELECT country, unnest({numbers('value_str')}) AS n FROM ({ORACLE["evidence_facts"]}) WHERE kind = 'str')
)"""

ORACLE["document_leaves"] = """
WITH shaped AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
    CASE WHEN o_orderkey % 31 = 0 THEN 'not a JSON object' WHEN o_orderkey % 37 = 0 THEN 'not valid JSON' END AS reason,
    o_orderkey % 3 AS shape
  FROM orders
), leaves AS (
  SELECT o_orderkey, unnest(CASE shape
    WHEN 0 THEN [{'path': 'key', 'kind': 'int', 'num': CAST(o_orderkey AS DOUBLE), 'str': NULL::VARCHAR},
                 {'path': 'even', 'kind': 'bool', 'num': NULL, 'str': CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END},
                 {'path': 'gone', 'kind': 'null', 'num': NULL, 'str': NULL}]
    WHEN 1 THEN [{'path': 'notes[0]', 'kind': 'str', 'num': NULL::DOUBLE, 'str': o_orderpriority},
                 {'path': 'notes[1]', 'kind': 'str', 'num': NULL, 'str': 'of 1,016'}]
    ELSE [{'path': 'a.b[0].status', 'kind': 'str', 'num': NULL::DOUBLE, 'str': o_orderstatus},
          {'path': 'a.b[0].price', 'kind': CASE WHEN price = floor(price) THEN 'int' ELSE 'float' END, 'num': price, 'str': NULL},
          {'path': 'a.b[1].status', 'kind': 'str', 'num': NULL, 'str': o_orderstatus},
          {'path': 'a.b[1].price', 'kind': CASE WHEN price = floor(price) THEN 'int' ELSE 'float' END, 'num': price, 'str': NULL},
          {'path': 'key', 'kind': 'int', 'num': CAST(o_orderkey AS DOUBLE), 'str': NULL}] END) AS leaf
  FROM shaped WHERE reason IS NULL
)
SELECT o_orderkey, leaf.path AS path, leaf.kind AS kind, leaf.num AS value_num, leaf.str AS value_str, NULL AS reason FROM leaves
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, reason FROM shaped WHERE reason IS NOT NULL"""

ORACLE["text_numbers_whole"] = f"""
WITH found AS (
  SELECT doc_id, lang, regexp_extract_all(regexp_replace(text, '([A-Za-z])[-+0-9]', '\\1 ', 'g'),
    '[-+]?(?:\\d{{1,3}}(?:,\\d{{3}})+|\\d+)(?:\\.\\d+)?%?') AS nums
  FROM documents
), tokens AS (
  SELECT doc_id, lang, unnest(generate_series(1, len(nums))) AS pos, unnest(nums) AS number FROM found
)
SELECT doc_id, lang, pos, number, {numval('number')} AS value FROM tokens"""

ORACLE["limitations_forms"] = """
SELECT o_orderkey, CASE o_orderkey % 5
  WHEN 0 THEN '- status ' || o_orderstatus || chr(10) || '- ' || o_orderpriority
  WHEN 1 THEN 'The following limitations were identified from the supplied dataset:' || chr(10) || chr(10)
    || '- order: ' || o_orderkey || chr(10) || '- notes: status ' || o_orderstatus || chr(10) || '- notes: ' || o_orderpriority
    || chr(10) || '- even: ' || CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END
  WHEN 2 THEN 'The analysis is limited to information available in the supplied dataset.'
  ELSE 'No additional limitations were identified by the deterministic analysis pipeline.' END AS body
FROM orders"""

ORACLE["prompt_dispatch"] = SECTION_PROMPTS + """,
asked AS (
  SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'NOWHERE' ELSE n_name END AS country,
    CASE c_custkey % 7 WHEN 0 THEN ' Narrative_Summary ' WHEN 1 THEN 'SUMMARY_ANALYSIS' WHEN 2 THEN 'reaction_analysis'
      WHEN 3 THEN 'serious_alert_analysis' || chr(9) WHEN 4 THEN 'trend_interpretation' WHEN 5 THEN 'conclusion' END AS section
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)
SELECT c_custkey, a.country, p.report_section, md5(p.prompt) AS prompt_md5,
  CASE WHEN p.prompt IS NOT NULL THEN NULL
       WHEN section IS NULL OR section = 'conclusion' THEN
         'No prompt for section ''' || coalesce(section, '') || '''; choose one of: narrative_summary, summary_analysis, '
         || 'reaction_analysis, serious_alert_analysis, trend_interpretation'
       ELSE 'The group of this request has no evidence.' END AS violation
FROM asked a LEFT JOIN prompts p
  ON p.country IS NOT DISTINCT FROM a.country AND p.report_section = lower(trim(section, ' ' || chr(9)))"""

ORACLE["case_store_merge"] = ORACLE["latest_version"]
