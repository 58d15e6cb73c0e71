"""The five-row synthetic workbook used by the reference's end-to-end test,
as a fixture (values only; every cell as text)."""

COLUMNS = [
    "safetyreportid", "safetyreportversion", "serious", "seriousnessdeath",
    "seriousnesslifethreatening", "seriousnesshospitalization", "seriousnessdisabling",
    "seriousnesscongenitalanomali", "seriousnessother", "fulfillexpeditecriteria",
    "primarysourcecountry", "occurcountry", "reporttype", "report_date",
    "patient_patientonsetage", "patient_patientonsetageunit", "patient_patientsex",
    "patient_patientweight", "primarysource_qualification",
    "patient_summary_narrativeincludeclinical", "patient_reaction_reactionmeddrapt",
    "patient_reaction_reactionoutcome", "patient_reaction_reactionmeddraversionpt",
    "patient_drug_drugcharacterization", "patient_drug_medicinalproduct",
    "patient_drug_activesubstance_activesubstancename", "patient_drug_drugdosagetext",
    "patient_drug_drugstructuredosagenumb", "patient_drug_drugstructuredosageunit",
    "patient_drug_drugadministrationroute", "patient_drug_drugindication",
    "patient_drug_actiondrug", "patient_drug_drugstartdate", "patient_drug_drugenddate",
]

ROWS = [
    ["1001", "1", "1", "0", "1", "1", "0", "0", "0", "1", "US", "US", "1", "2025-01-15", "72", "year", "2",
     "68", "1", "Elderly patient reported hypotension.", "Hypotension,Dizziness", "recovering,recovering",
     "26.1,26.1", "1", "Concor", "BISOPROLOL FUMARATE", "5 mg daily", "5", "mg", "oral", "hypertension",
     "dose reduced", "20240101", ""],
    ["1001", "2", "1", "0", "1", "1", "0", "0", "0", "1", "US", "US", "1", "2025-01-20", "72", "year", "2",
     "68", "1", "Updated version of the same case.", "Hypotension,Dizziness,Bradycardia",
     "recovering,recovering,unknown", "26.1,26.1,26.1", "1", "Concor", "BISOPROLOL FUMARATE", "5 mg daily",
     "5", "mg", "oral", "hypertension", "dose reduced", "20240101", ""],
    ["1002", "1", "1", "1", "0", "0", "0", "0", "0", "1", "DE", "DE", "1", "2025-03-02", "81", "year", "1",
     "74", "1", "Fatal case with acute kidney injury.", "Acute kidney injury,Death", "fatal,fatal",
     "26.1,26.1", "1,2", "Bisoprolol,Aspirin", "BISOPROLOL,ACETYLSALICYLIC ACID",
     "2.5 mg daily,100 mg daily", "2.5,100", "mg,mg", "oral,oral", "heart failure,prophylaxis",
     "unknown,unknown", "20231201,20231201", ","],
    ["1003", "1", "0", "0", "0", "0", "0", "0", "0", "0", "IN", "IN", "1", "2025-06-10", "45", "year", "2",
     "61", "3", "Non-serious fatigue report.", "Fatigue", "recovered", "26.1", "1", "Bisoprolol",
     "BISOPROLOL", "2.5 mg daily", "2.5", "mg", "oral", "hypertension", "dose not changed", "20250201", ""],
    ["2001", "1", "1", "0", "0", "1", "0", "0", "0", "0", "FR", "FR", "1", "2025-02-08", "30", "year", "1",
     "80", "1", "Unrelated product case.", "Nausea", "recovered", "26.1", "1", "Metformin", "METFORMIN",
     "500 mg", "500", "mg", "oral", "diabetes", "unknown", "20250101", ""],
]


def sample_raw(spark):
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame(ROWS, schema)
