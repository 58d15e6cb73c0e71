"""Run parameters and fixed values.

Every operator takes column names and sets as arguments; the defaults below
reproduce the behaviour of the case-safety pipeline this engine mirrors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the reference pipeline's values for results
# to match. Kept verbatim and in their natural order.
# ---------------------------------------------------------------------------

# Raw columns that must be present (error lists every missing one).
REQUIRED_RAW_COLUMNS = (
    "safetyreportid",
    "safetyreportversion",
    "serious",
    "seriousnessdeath",
    "seriousnesslifethreatening",
    "seriousnesshospitalization",
    "seriousnessdisabling",
    "seriousnesscongenitalanomali",
    "seriousnessother",
    "fulfillexpeditecriteria",
    "primarysourcecountry",
    "occurcountry",
    "reporttype",
    "patient_patientonsetage",
    "patient_patientonsetageunit",
    "patient_patientsex",
    "patient_reaction_reactionmeddrapt",
    "patient_reaction_reactionoutcome",
    "patient_drug_drugcharacterization",
    "patient_drug_medicinalproduct",
    "patient_drug_activesubstance_activesubstancename",
)

# Columns kept for the case table, in order (only those present are kept).
CASE_COLUMNS = (
    "safetyreportid",
    "safetyreportversion",
    "primarysourcecountry",
    "occurcountry",
    "reporttype",
    "report_date",
    "serious",
    "seriousnessdeath",
    "seriousnesslifethreatening",
    "seriousnesshospitalization",
    "seriousnessdisabling",
    "seriousnesscongenitalanomali",
    "seriousnessother",
    "fulfillexpeditecriteria",
    "patient_patientonsetage",
    "patient_patientonsetageunit",
    "patient_patientsex",
    "patient_patientweight",
    "primarysource_qualification",
    "patient_summary_narrativeincludeclinical",
)

# Case columns lower-cased and stripped.
CATEGORICAL_COLUMNS = (
    "primarysourcecountry",
    "occurcountry",
    "reporttype",
    "serious",
    "seriousnessdeath",
    "seriousnesslifethreatening",
    "seriousnesshospitalization",
    "seriousnessdisabling",
    "seriousnesscongenitalanomali",
    "seriousnessother",
    "fulfillexpeditecriteria",
    "patient_patientsex",
    "primarysource_qualification",
)

# Columns any of which marks a case serious.
SERIOUSNESS_COLUMNS = (
    "serious",
    "seriousnessdeath",
    "seriousnesslifethreatening",
    "seriousnesshospitalization",
    "seriousnessdisabling",
    "seriousnesscongenitalanomali",
    "seriousnessother",
)

# Per-flag rate name -> column.
SERIOUSNESS_FLAGS = (
    ("death", "seriousnessdeath"),
    ("life_threatening", "seriousnesslifethreatening"),
    ("hospitalization", "seriousnesshospitalization"),
    ("disability", "seriousnessdisabling"),
    ("congenital_anomaly", "seriousnesscongenitalanomali"),
    ("other_serious", "seriousnessother"),
)

# Case flag column -> name carried on each reaction row.
REACTION_CASE_FLAGS = (
    ("serious", "case_serious"),
    ("seriousnessdeath", "case_death"),
    ("seriousnesslifethreatening", "case_life_threatening"),
    ("seriousnesshospitalization", "case_hospitalization"),
    ("seriousnessdisabling", "case_disabling"),
    ("seriousnesscongenitalanomali", "case_congenital_anomaly"),
    ("seriousnessother", "case_other_serious"),
)

# Optional packed drug columns -> child column name.
OPTIONAL_DRUG_FIELDS = (
    ("patient_drug_drugdosagetext", "dose_text"),
    ("patient_drug_drugstructuredosagenumb", "dose_number"),
    ("patient_drug_drugstructuredosageunit", "dose_unit"),
    ("patient_drug_drugadministrationroute", "route"),
    ("patient_drug_drugindication", "indication"),
    ("patient_drug_actiondrug", "action_taken"),
    ("patient_drug_drugstartdate", "start_date"),
    ("patient_drug_drugenddate", "end_date"),
)

# Truthy sets; they differ on purpose between uses.
SERIOUS_VALUES = ("1", "yes", "y")
NON_SERIOUS_VALUES = ("0", "false", "no")
FLAG_VALUES = ("1", "true", "yes")
REACTION_SERIOUS_VALUES = ("1", "true", "yes", "serious")

DEFAULT_TARGET_PATTERN = r"\bBISOPROLOL(?:\s+FUMARATE)?\b"
TOP_N = 10
# Values that a free-text category lists in an evidence document, and the name under
# which the rest is counted (values are lower case, so it is never one of them).
MAX_VALUES = 1000
FURTHER_VALUES = "Further values"
TOP_K_CONCENTRATION = 5

# Age bands: (upper bound exclusive, label); at or above the last -> elderly.
AGE_BANDS = (
    (1, "infant"),
    (12, "child"),
    (18, "adolescent"),
    (65, "adult"),
)
AGE_ELDERLY = "elderly"
AGE_UNKNOWN = "unknown"
UNKNOWN_VALUE = "unknown"

# Numbers in free text (first alternative wins, as in the reference).
NUMBER_PATTERN = (
    r"(?<![A-Za-z])[-+]?\p{Nd}{1,3}(?:,\p{Nd}{3})*(?:\.\p{Nd}+)?%?"
    r"|(?<![A-Za-z])[-+]?\p{Nd}+(?:\.\p{Nd}+)?%?"
)

# The same tokens, but a number of four or more digits without separators stays whole.
WHOLE_NUMBER_PATTERN = r"(?<![A-Za-z])[-+]?(?:\p{Nd}{1,3}(?:,\p{Nd}{3})+(?!\p{Nd})|\p{Nd}+)(?:\.\p{Nd}+)?%?"

# Phrases flagged in generated text, in order.
FLAGGED_PHRASES = (
    "caused by",
    "causes",
    "caused",
    "proves that",
    "confirmed safety signal",
    "confirmed signal",
    "causal relationship",
    "causally related",
    "definitively related",
    "regulatory action",
    "should be withdrawn",
    "should be discontinued",
    "should be contraindicated",
    "clinically significant safety signal",
)
CLAIM_MESSAGE_PREFIX = "Potentially unsupported claim: '"
EMPTY_TEXT_FINDING = "Generated text is empty."

# Fixed limitation sentences appended after the computed ones.
FIXED_LIMITATIONS = (
    "System Organ Class (SOC) analysis was not performed unless SOC information was explicitly supplied in the dataset.",
    "Expectedness analysis was not performed because label/CCDS/reference safety information was not supplied.",
    "No causality inference was performed beyond information explicitly present in the supplied dataset.",
    "No regulatory or safety action conclusion was generated unless explicit action information was supplied.",
)
MISSING_AGE_NOTE = "Age was unavailable or could not be normalized for %d cases."
MISSING_SEX_NOTE = "Sex was missing for %d cases."
MISSING_DATE_NOTE = "Reporting date was unavailable for %d cases."

ALERT_INTERPRETATIONS = (
    ("expedite_cases", "fulfillexpeditecriteria", "Cases meeting the supplied expedite criterion."),
    ("death_cases", "seriousnessdeath", "Cases containing a supplied death seriousness indicator."),
    (
        "life_threatening_cases",
        "seriousnesslifethreatening",
        "Cases containing a supplied life-threatening seriousness indicator.",
    ),
)

METADATA = (
    ("analysis_type", "Deterministic ICSR safety analysis"),
    ("target_product", "Bisoprolol"),
    ("source", "Bisoprolol ICSR dataset"),
    ("analysis_principle", "Python-calculated facts are the source of truth."),
)

# Report sections: name -> top-level evidence keys handed to it.
SECTION_MAP = (
    (
        "narrative_summary",
        ("reporting_period", "case_summary", "seriousness", "demographics", "outcomes", "limitations"),
    ),
    (
        "summary_analysis",
        ("case_summary", "seriousness", "demographics", "outcomes", "limitations", "trends"),
    ),
    ("reaction_analysis", ("reactions", "seriousness", "limitations")),
    ("serious_alert_analysis", ("case_summary", "seriousness", "alerts", "limitations")),
    ("trend_interpretation", ("reporting_period", "trends", "reactions", "limitations")),
)
SECTION_TITLES = (
    ("narrative_summary", "Narrative Summary"),
    ("summary_analysis", "Summary Analysis"),
    ("reaction_analysis", "Reaction Analysis"),
    ("serious_alert_analysis", "Serious and Alert Case Analysis"),
    ("trend_interpretation", "Trend Interpretation"),
)

GROUNDING_RULES = """
Use only the supplied evidence.
Do not invent facts or numbers.
Do not calculate statistics.
Do not infer causality, expectedness, or clinical significance.
Do not make regulatory recommendations.
Use concise, neutral regulatory-style language.
Return only the requested section.
Do not repeat the instructions.
"""

SECTION_INSTRUCTIONS = (
    (
        "narrative_summary",
        """
Write a concise narrative summary using only the supplied evidence.
Do not invent or create new evidence or information.
Write a grammatically correct, concise English paragraph.
""",
    ),
    (
        "summary_analysis",
        """
Write a concise summary analysis using only the supplied evidence.
Cover case counts, seriousness, demographics, reactions, outcomes, and trend values.
Do not calculate or recompute statistics.
""",
    ),
    (
        "reaction_analysis",
        """
Analyze the supplied reaction evidence and write a concise regulatory-style summary covering:
- Total reaction occurrences and the most frequently reported reactions.
- Any notable reaction concentrations identified in the evidence.
Use only the supplied evidence. Do not calculate, infer causality, or introduce unsupported conclusions.
""",
    ),
    (
        "serious_alert_analysis",
        """
Describe the supplied serious and alert case evidence in a concise regulatory-style summary covering:
- Total serious, non-serious, and expedite/alert cases.
- Main seriousness categories, including death, life-threatening, and other serious outcomes.
Use only the supplied evidence. Do not describe alerts as confirmed safety signals.
""",
    ),
    (
        "trend_interpretation",
        """
Analyze the supplied temporal evidence and write a concise regulatory-style summary covering:
- Reporting period and highest/lowest monthly case counts.
- First and last month case counts.
- Observed absolute and percentage change between the first and last month.
Use only the supplied values. Do not invent dates or reconstruct monthly data.
""",
    ),
)
PROMPT_CLOSING = "Write only the final section text."
FALLBACK_NO_EVIDENCE = "Evidence was not supplied for this section."
FALLBACK_UNPARSABLE = "Evidence could not be parsed for this section."
FALLBACK_MODEL = "deterministic-fallback"
DEFAULT_MODEL_NAME = "Qwen/Qwen2.5-0.5B-Instruct"

REPORT_TITLE = "# PADER-Style Safety Report"
PERIOD_UNAVAILABLE = "Reporting period information was not available in the supplied dataset."
PERIOD_SENTENCE = "The available reporting period extends from %s to %s, covering %s month(s)."
CASE_SENTENCE = (
    "A total of %s unique cases were identified. Of these, %s were classified as serious "
    "and %s as non-serious. %s cases met the supplied expedite/alert criterion."
)
METHODOLOGY_TEXT = (
    "The analysis was performed using a deterministic Python pipeline. "
    "The supplied ICSR dataset was validated and cleaned before case-level and "
    "reaction-level analyses were performed.\n\n"
    "Case-level statistics were calculated using unique safety report identifiers, "
    "while reaction occurrences were analyzed separately. Missing information was "
    "retained as unavailable/unknown where appropriate.\n\n"
    "The resulting validated statistics were stored in an Evidence JSON structure. "
    "A language model (%s unless MOCK_LLM is enabled) was subsequently "
    "used only to convert selected validated findings into concise narrative text.\n\n"
    "Generated content was subjected to numerical and claim-level grounding checks "
    "and sections failing validation were flagged for human review."
)
# Around the name of a section that no prompt exists for; the supported names follow.
UNKNOWN_SECTION_TEXT = ("No prompt for section '", "'; choose one of: ")
NO_EVIDENCE_TEXT = "The group of this request has no evidence."
NO_LIMITATIONS_TEXT = "No additional limitations were identified by the deterministic analysis pipeline."
ONLY_NULL_LIMITATIONS_TEXT = "The analysis is limited to information available in the supplied dataset."
NAMED_LIMITATIONS_INTRO = "The following limitations were identified from the supplied dataset:"
REVIEW_PENDING = "**Report Status: PENDING HUMAN REVIEW**"
REVIEW_LIST_INTRO = "The following generated sections require human review:"
REVIEW_PASSED = (
    "Automated grounding validation passed for the generated sections. "
    "Human review is still required before final approval."
)
REVIEW_CHECKLIST = (
    "### Review Checklist\n\n"
    "- [ ] Analysis verified\n"
    "- [ ] Generated sections reviewed\n"
    "- [ ] Evidence checked\n"
    "- [ ] Final report approved"
)
TRACEABILITY_TEXT = (
    "The report was generated from deterministic analysis results stored in `output/evidence.json`.\n\n"
    "The language model was not provided with the raw ICSR Excel dataset.\n\n"
    "Numerical and categorical analysis was performed before language generation.\n\n"
    "Unsupported generated content is flagged for human review."
)
REPORT_HEADINGS = (
    "1. Reporting Period",
    "2. Narrative Summary",
    "3. Case Summary",
    "4. Summary Analysis",
    "5. Reaction Analysis",
    "6. Serious and Alert Case Analysis",
    "7. Trend Interpretation",
    "8. Methodology",
    "9. Limitations",
    "10. Human Review",
    "11. Evidence Traceability",
)

# Free-form date formats tried in order when a value is not 8 digits.
DATE_FORMATS = (
    "yyyy-M-d",
    "yyyy/M/d",
    "M/d/yyyy",
    "d/M/yyyy",
    "d MMM yyyy",
    "yyyy-M",
    "yyyy",
)

# Rewritten before the formats are tried, as (pattern, replacement): a time of
# day is cut, and a date with a month name (long or short, any case) becomes
# "day name year".
_MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?\\.?"
DATE_REWRITES = (
    (r"^(\d{4}[-/]\d{1,2}[-/]\d{1,2})[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:Z|[-+]\d{2}:?\d{2})?$", "$1"),
    (rf"(?i)^(\d{{1,2}})[- ]{_MONTH}[-, ]+(\d{{4}})$", "$1 $2 $3"),
    (rf"(?i)^{_MONTH} (\d{{1,2}}),? +(\d{{4}})$", "$2 $1 $3"),
    (rf"(?i)^{_MONTH},?[- ](\d{{4}})$", "1 $1 $2"),
)

# Reader null sentinels (cells equal to one of these read as null).
NULL_SENTINELS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


@dataclass(frozen=True)
class RunParams:
    """Parameters a user can turn for one run."""

    filter_to_target: bool = True
    target_pattern: str = DEFAULT_TARGET_PATTERN
    target_label: str = "Bisoprolol"
    top_n: int = TOP_N
    top_k: int = TOP_K_CONCENTRATION
    max_values: int = MAX_VALUES
    model_name: str = DEFAULT_MODEL_NAME
    mock_text: bool = True
    null_sentinels: tuple[str, ...] = field(default=NULL_SENTINELS)
