"""Fixed values. They must equal the published item ids, outcome codes and scales for results to agree."""

# Item ids of vital signs in the calendar-ICU chart table.
VITAL_ITEMS = {
    220045: "Heart_Rate",
    220050: "Arterial_BP_Systolic",
    220051: "Arterial_BP_Diastolic",
    220179: "Systolic_BP",
    220180: "Diastolic_BP",
    220210: "Respiratory_Rate",
    220277: "SpO2",
    223761: "Temperature_F",
    223900: "GCS_Total",
}

# Item ids of laboratory tests in the calendar-ICU lab table.
LAB_ITEMS = {
    50813: "Lactate",
    50868: "Anion_Gap",
    50882: "Bicarbonate",
    50893: "Calcium_Total",
    50902: "Chloride",
    50912: "Creatinine",
    50931: "Glucose",
    50960: "Magnesium",
    50971: "Potassium",
    50983: "Sodium",
    51006: "BUN",
    51221: "Hematocrit",
    51222: "Hemoglobin",
    51265: "Platelet_Count",
    51301: "WBC",
}

# Item ids used by the stand-alone calendar-ICU reshapes.
PREP_VITAL_ITEMS = {
    220045: "heart_rate",
    220050: "sbp",
    220051: "dbp",
    220052: "mbp",
    220210: "resp_rate",
    220277: "spo2",
    223761: "temperature",
}
PREP_LAB_ITEMS = {
    50882: "bicarbonate",
    50902: "chloride",
    50912: "creatinine",
    50931: "glucose",
    50971: "potassium",
    50983: "sodium",
    51006: "bun",
    51221: "hematocrit",
    51265: "platelet",
    51301: "wbc",
}

# Columns of the offset-ICU vital-sign tables, in feature order.
PERIODIC_VITALS = ["temperature", "sao2", "heartrate", "respiration", "systemicsystolic", "systemicdiastolic"]
APERIODIC_VITALS = ["noninvasivesystolic", "noninvasivediastolic"]

# Emergency-department outcomes: unlisted dispositions are dropped in the first map and censored in the second.
ED_OUTCOMES = {"Discharge": 0, "ICU": 1, "Inpatient": 2, "Observation": 3}
ED_OUTCOME_NAMES = {0: "Censored", 1: "ICU Admission", 2: "Hospital Admission", 3: "Observation"}
PREP_OUTCOMES = {"HOME": 0, "ICU": 1, "FLOOR": 2, "OBSERVATION": 3, "DIED": 1, "LEFT": 0}

# Triage acuity as an ordinal; -1 stands for an unknown level.
TRIAGE_ACUITY = {
    "1-Resuscitation": 5,
    "2-Emergent": 4,
    "3-Urgent": 3,
    "4-Semi-Urgent": 2,
    "5-Non-Urgent": 1,
}

# Emergency-department columns that a visit must have, and its numeric static features.
ED_REQUIRED = [
    "Race", "Ethnicity", "Triage_Temp", "Triage_HR", "Triage_RR", "Triage_SpO2", "Triage_SBP", "Triage_DBP",
    "Triage_acuity", "ED_LOS", "ED_dispo",
]
ED_NUMERIC = ["Age", "Triage_Temp", "Triage_HR", "Triage_RR", "Triage_SpO2", "Triage_SBP", "Triage_DBP"]
ED_CATEGORIES = ["Race", "Gender", "Ethnicity"]
