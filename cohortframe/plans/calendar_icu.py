"""ICU data with calendar time stamps, patient-keyed labs, coded admissions and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.functions.fixed import LAB_ITEMS, VITAL_ITEMS
from cohortframe.operators import codes as K, cohort as C, events as E, reports as R, survival, timeaxis
from cohortframe.operators.losses import Losses
from cohortframe.params import Preparation
from cohortframe.plans import common, spec

STATIC = common.Static(["anchor_age"], ["gender", "first_careunit", "admission_type", "admission_location"])


def cohort_stays(
    icustays: DataFrame, patients: DataFrame, admissions: DataFrame, min_stay_hours: float = 24.0, horizon: float = 240.0,
    losses: Losses | None = None,
) -> DataFrame:
    """First stay of each patient, then adults, then a minimum stay; labelled by death within the horizon.

    The first stay is taken before the joins: they add columns, not rows, and so see one stay per patient.
    """
    losses = losses or Losses()
    first = losses.passed(C.first_stay(losses.passed(icustays, "icustays")), "icustays", "later stay of the patient or no start")
    first = C.stays_with_admissions(first, patients, admissions)
    adult = losses.passed(C.adults(first, "anchor_age"), "icustays", "age below 18 or unknown")
    timed = adult.withColumn("los_hours", S.hours_between("intime", "outtime"))
    kept = losses.passed(C.min_stay(timed, "los_hours", min_stay_hours), "icustays", "stay too short or without end").drop("los_hours")
    return survival.labels_from_calendar(kept, horizon)


def hourly_cells(
    stays: DataFrame,
    chartevents: DataFrame | None,
    labevents: DataFrame | None,
    max_hours: int,
    vital_items: dict = VITAL_ITEMS,
    lab_items: dict = LAB_ITEMS,
    losses: Losses | None = None,
) -> DataFrame:
    """Listed vitals by stay and labs by patient, pooled to hourly means; either may be absent."""
    losses = losses or Losses()
    anchors = stays.select("stay_id", "split", F.col("intime").alias("anchor_ts"))
    subjects = stays.select("subject_id", "stay_id", "split", F.col("intime").alias("anchor_ts"))
    columns = ["stay_id", "split", "hours", "feature", F.col("valuenum").alias("value")]
    parts = []
    if chartevents is not None:
        vitals = E.name_items(losses.keep(chartevents, "chartevents", _unusable(vital_items)), vital_items)
        vitals = timeaxis.anchor_to_stays(vitals, anchors, "stay_id", "charttime")
        vitals = losses.passed(vitals, "chartevents", "of no stay in the cohort")
        vitals = timeaxis.within(vitals, max_hours).select(*columns)
        parts.append(losses.passed(vitals, "chartevents", "outside the window"))
    if labevents is not None:
        labs = E.name_items(losses.keep(labevents, "labevents", _unusable(lab_items)), lab_items)
        # A patient has one stay here, so an event meets one at most.
        labs = timeaxis.fan_out_to_stays(labs, subjects, max_hours, "subject_id", "charttime").select(*columns)
        parts.append(losses.passed(labs, "labevents", "outside the window of a stay in the cohort"))
    return E.hourly_mean(E.union_series(*parts), ["stay_id", "split"])


def _unusable(items: dict) -> dict:
    missing = F.col("valuenum").isNull() | F.isnan(F.col("valuenum").cast("double"))
    return {"item not listed": ~F.coalesce(F.col("itemid").isin(*items), F.lit(False)), "no value": missing, "no time": F.col("charttime").isNull()}


def stay_codes(
    cohort: DataFrame, diagnoses: DataFrame, admissions: DataFrame, params: Preparation
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary of the most frequent codes and the stays' binary code cells.

    ``history`` takes codes of admissions strictly before the stay. ``current`` takes those of the stay's own
    admission, which are assigned at discharge and so know the outcome.
    """
    stays = cohort.select("stay_id", "subject_id", "hadm_id", "split", F.col("intime").alias("anchor_ts"))
    fit = common.train_of(stays) if params.codes.fit_on == "train" else stays
    coded = diagnoses.withColumnRenamed("icd_code", "code")
    if params.codes.mode == "history":
        times = admissions.select("hadm_id", F.col("admittime").alias("coded_ts"))
        records = session.barrier(K.code_records(E.members(coded, stays, "subject_id").join(times, "hadm_id")), "code_records")
        vocab = session.held(K.top_codes(K.past_code_counts(fit, records), params.codes.top_n))
        found = K.past_codes(stays, K.restrict_codes(records, vocab))
    else:
        # The codes of the stays' own admissions, written: the vocabulary and the cells both read them.
        own = session.barrier(K.current_code_counts(stays, coded, "split"), "own_codes")
        counted = own.where("split = 'train'") if params.codes.fit_on == "train" else own
        vocab = session.held(K.top_codes(K.total_counts(counted), params.codes.top_n))
        found = K.restrict_codes(own, vocab).select("stay_id", "code")
    named = vocab.withColumn("feature", F.concat(F.lit(params.codes.prefix), F.col("code")))
    return named, K.code_cells(found, vocab, params.codes.value)


def stay_reports(cohort: DataFrame, radiology: DataFrame, max_hours: int, losses: Losses | None = None) -> DataFrame:
    """Texts written within the input window of the stay's own admission."""
    losses = losses or Losses()
    stays = cohort.select("stay_id", "subject_id", "hadm_id", F.col("intime").alias("anchor_ts"))
    known = losses.keep(radiology, "radiology", {"no text": F.col("text").isNull(), "no time": F.col("charttime").isNull()})
    joined = losses.passed(R.join_reports(known, stays), "radiology", "of no stay in the cohort")
    timed = timeaxis.within(joined.withColumn("hours", S.hours_between("anchor_ts", "charttime")), max_hours)
    return losses.passed(timed.select("stay_id", "hours", "text"), "radiology", "outside the window")


def prepare(
    icustays: DataFrame,
    patients: DataFrame,
    admissions: DataFrame,
    chartevents: DataFrame | None = None,
    labevents: DataFrame | None = None,
    diagnoses: DataFrame | None = None,
    radiology: DataFrame | None = None,
    params: Preparation = Preparation(presence_denominator="grid"),
    min_stay_hours: float = 24.0,
    encoder: R.Encoder | None = None,
    encoder_dim: int | None = None,
    static: bool = True,
    vital_items: dict = VITAL_ITEMS,
    lab_items: dict = LAB_ITEMS,
) -> dict[str, DataFrame]:
    """Prepare whichever parts are given: series (chart and lab events), static, codes, reports."""
    inputs = {
        "icustays": icustays, "patients": patients, "admissions": admissions, "chartevents": chartevents, "labevents": labevents,
        "diagnoses": diagnoses, "radiology": radiology,
    }
    return spec.prepare(data_set(min_stay_hours, vital_items, lab_items), inputs, params, static, encoder, encoder_dim)


def data_set(min_stay_hours: float = 24.0, vital_items: dict = VITAL_ITEMS, lab_items: dict = LAB_ITEMS) -> spec.DataSet:
    def stays(given, params, losses):
        return cohort_stays(given["icustays"], given["patients"], given["admissions"], min_stay_hours, params.labels.horizon_hours, losses)

    def cells(given, cohort, params, losses):
        return hourly_cells(cohort, given.get("chartevents"), given.get("labevents"), params.windows.max_hours, vital_items, lab_items, losses)

    def codes(given, cohort, params):
        return spec.Codes(*stay_codes(cohort, given["diagnoses"], given["admissions"], params))

    def texts(given, cohort, params, losses):
        return stay_reports(cohort, given["radiology"], params.windows.max_hours, losses)

    return spec.DataSet(
        stays, STATIC, cells, ["chartevents", "labevents"], codes, "diagnoses", texts, "radiology",
        {"icustays": ["subject_id", "hadm_id", "stay_id", "intime"]},
    )
