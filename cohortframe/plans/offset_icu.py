"""ICU data whose times are minute offsets from admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.functions import scalars as S
from cohortframe.functions.fixed import APERIODIC_VITALS, PERIODIC_VITALS
from cohortframe.operators import cohort as C, events as E, survival, timeaxis
from cohortframe.operators.losses import Losses
from cohortframe.params import Preparation
from cohortframe.plans import common, spec

SERIES = ("vital_periodic", "vital_aperiodic", "lab")
STATIC = common.Static(["age"], ["gender", "ethnicity", "unitstaytype"])


def cohort_stays(
    patient: DataFrame, min_stay_hours: float = 24.0, horizon: float = 240.0, losses: Losses | None = None
) -> DataFrame:
    """Adults with a numeric age and a minimum stay, labelled by discharge status."""
    losses = losses or Losses()
    named = C.canonical(
        patient, {"patientunitstayid": "stay_id", "patienthealthsystemstayid": "subject_id"}
    )
    named = C.require_columns(named, ["stay_id", "subject_id"])
    known = losses.passed(C.numeric_text(losses.passed(named, "patient"), "age"), "patient", "age is no number")
    adult = losses.passed(C.adults(known), "patient", "age below 18")
    long_enough = C.min_stay(adult.withColumn("los_hours", F.col("unitdischargeoffset") / 60.0), "los_hours", min_stay_hours)
    long_enough = losses.passed(long_enough, "patient", "stay too short or without end")
    return survival.labels_from_offsets(
        long_enough, "unitdischargeoffset", "hospitaldischargestatus", "Expired", horizon
    ).drop("los_hours", "unitdischargeoffset", "hospitaldischargestatus")


def _timed(df: DataFrame, offset: str, max_hours: int, losses: Losses, name: str, **reasons: Column) -> DataFrame:
    """Rows inside the input window, with ``hours`` since admission."""
    hours = df.withColumn("hours", F.col(offset) / 60.0)
    lost = {"no time": F.col("hours").isNull(), "outside the window": ~timeaxis.inside(max_hours)}
    return losses.keep(hours, name, {k.replace("_", " "): v for k, v in reasons.items()} | lost)


def hourly_vitals(vitals: DataFrame, columns: list) -> DataFrame:
    """Hourly means, wide first: all columns of a table are averaged in one pass and only the means are unrolled.

    ``vitals`` carry ``hours``. NULL means stay as rows because they count as existing (stay, hour) rows.
    """
    binned = vitals.withColumnRenamed("patientunitstayid", "stay_id").withColumn("hour", S.hour_bin("hours"))
    hourly = binned.groupBy("stay_id", "hour").agg(*[F.avg(c).alias(c) for c in columns])
    return E.long_from_wide(hourly, ["stay_id", "hour"], columns, keep_null=True)


def hourly_labs(lab: DataFrame) -> DataFrame:
    named = C.canonical(
        lab, {"patientunitstayid": "stay_id", "labresultoffset": "instant", "labname": "feature", "labresult": "value"}
    )
    return E.instant_then_hour_mean(named)


def hourly_cells(
    stays: DataFrame, vital_periodic: DataFrame | None, vital_aperiodic: DataFrame | None, lab: DataFrame | None, max_hours: int,
    losses: Losses | None = None,
) -> DataFrame:
    """All series as long hourly cells of the cohort; any of them may be absent.

    Rows outside the window and of other stays go before the aggregates; the planner broadcasts the stays' ids where their
    size allows.
    """
    losses = losses or Losses()
    ids = stays.select(F.col("stay_id").alias("patientunitstayid"), "split")

    def own(df: DataFrame, name: str) -> DataFrame:
        kept = E.members(df, ids, "patientunitstayid")
        return losses.passed(kept, name, "of no stay in the cohort")

    vitals = (("vital_periodic", vital_periodic, PERIODIC_VITALS), ("vital_aperiodic", vital_aperiodic, APERIODIC_VITALS))
    parts = [
        hourly_vitals(own(_timed(df, "observationoffset", max_hours, losses, name), name), columns)
        for name, df, columns in vitals if df is not None
    ]
    if lab is not None:
        known = _timed(lab, "labresultoffset", max_hours, losses, "lab", no_value=F.col("labresult").isNull())
        parts.append(hourly_labs(own(known, "lab")))
    cells = E.union_series(*parts)
    order = {name: i for i, name in enumerate([*PERIODIC_VITALS, *APERIODIC_VITALS])}
    return E.with_split(cells, stays).withColumn("block", S.lookup("feature", order, len(order)))


def prepare(
    patient: DataFrame,
    vital_periodic: DataFrame | None,
    vital_aperiodic: DataFrame | None,
    lab: DataFrame | None,
    params: Preparation = Preparation(),
    min_stay_hours: float = 24.0,
    static: bool = True,
) -> dict[str, DataFrame]:
    inputs = {"patient": patient, "vital_periodic": vital_periodic, "vital_aperiodic": vital_aperiodic, "lab": lab}
    return spec.prepare(data_set(min_stay_hours), inputs, params, static)


def data_set(min_stay_hours: float = 24.0) -> spec.DataSet:
    def stays(given, params, losses):
        return cohort_stays(given["patient"], min_stay_hours, params.labels.horizon_hours, losses)

    def cells(given, cohort, params, losses):
        return hourly_cells(cohort, *map(given.get, SERIES), params.windows.max_hours, losses)

    return spec.DataSet(stays, STATIC, cells, SERIES)
