"""Schemas of the raw inputs. Types are never inferred: codes must stay text."""

PATIENT = (
    "patientunitstayid bigint, patienthealthsystemstayid bigint, gender string, age string, ethnicity string, "
    "unitstaytype string, unitdischargeoffset bigint, hospitaldischargestatus string"
)
VITAL_PERIODIC = (
    "patientunitstayid bigint, observationoffset bigint, temperature double, sao2 double, heartrate double, "
    "respiration double, systemicsystolic double, systemicdiastolic double"
)
VITAL_APERIODIC = (
    "patientunitstayid bigint, observationoffset bigint, noninvasivesystolic double, noninvasivediastolic double"
)
LAB = "patientunitstayid bigint, labresultoffset bigint, labname string, labresult double"

ICUSTAYS = (
    "subject_id bigint, hadm_id bigint, stay_id bigint, first_careunit string, intime timestamp, outtime timestamp"
)
PATIENTS = "subject_id bigint, gender string, anchor_age int, dod timestamp"
ADMISSIONS = (
    "subject_id bigint, hadm_id bigint, admittime timestamp, dischtime timestamp, deathtime timestamp, "
    "admission_type string, admission_location string"
)
CHARTEVENTS = "stay_id bigint, charttime timestamp, itemid int, valuenum double"
LABEVENTS = "subject_id bigint, charttime timestamp, itemid int, valuenum double"
DIAGNOSES = "subject_id bigint, hadm_id bigint, icd_code string"
RADIOLOGY = "subject_id bigint, hadm_id bigint, charttime timestamp, text string"

VISITS = (
    "MRN bigint, CSN bigint, Age double, Triage_Temp double, Triage_HR double, Triage_RR double, Triage_SpO2 double, "
    "Triage_SBP double, Triage_DBP double, Gender string, Race string, Ethnicity string, Triage_acuity string, "
    "ED_LOS double, ED_dispo string"
)
ED_LABS = "CSN bigint, Result_time string, Component_name string, Component_value string"
ED_NUMERICS = "CSN bigint, Time string, Measure string, Value double"
PMH = "MRN bigint, Code string"
RADS = "CSN bigint, Study string, Impression string"

EDSTAYS = "stay_id bigint, subject_id bigint, intime timestamp, outtime timestamp"
DISPOSITIONS = "stay_id bigint, disposition string"
PREP_PATIENTS = "subject_id bigint, gender string, race string, insurance string, anchor_age int"
PREP_DIAGNOSES = "stay_id bigint, icd_code string"
