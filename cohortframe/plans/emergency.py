"""Emergency-department visits: competing outcomes, time counted from the first measurement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.functions.fixed import (
    ED_CATEGORIES, ED_NUMERIC, ED_OUTCOME_NAMES, ED_OUTCOMES, ED_REQUIRED, TRIAGE_ACUITY,
)
from cohortframe.operators import codes as K, cohort as C, events as E, reports as R, select, survival, timeaxis
from cohortframe.operators.losses import Losses
from cohortframe.params import Codes, Labels, Preparation, Windows
from cohortframe.plans import common, spec
from cohortframe.sources import tables

STATIC = common.Static(ED_NUMERIC, ED_CATEGORIES, ["Triage_acuity_ordinal"])
DEFAULTS = Preparation(
    windows=Windows(6, 1),
    labels=Labels(horizon_hours=24.0, outcomes=ED_OUTCOME_NAMES, competing=True),
    codes=Codes(value="count", fit_on="all", prefix="icd_"),
    presence_denominator="grid_nonempty",
)


def visit_rows(visits: DataFrame, horizon: float, losses: Losses | None = None) -> DataFrame:
    """Complete visits with a listed outcome and a length of stay within the horizon."""
    losses = losses or Losses()
    complete = losses.passed(C.complete_cases(losses.passed(visits, "visits"), ED_REQUIRED), "visits", "a required column is empty")
    coded = losses.passed(C.map_outcome(complete, "ED_dispo", ED_OUTCOMES, "outcome"), "visits", "outcome not listed")
    within = losses.passed(C.exclude_longer(coded, "ED_LOS", horizon), "visits", "stay beyond the horizon")
    named = C.canonical(within, {"CSN": "stay_id", "MRN": "subject_id"})
    acuity = S.lookup("Triage_acuity", TRIAGE_ACUITY, -1)
    return survival.labels_competing(named.withColumn("Triage_acuity_ordinal", acuity), "ED_LOS", "outcome")


def first_values(df: DataFrame, cohort: DataFrame, block: int, losses: Losses, name: str) -> DataFrame:
    """First value per stay, instant and feature of the cohort, as a number or NULL where the text is none."""
    kept = losses.keep(df, name, {
        "no value": F.col("value").isNull(), "no feature": F.col("feature").isNull(), "no time": F.col("time").isNull(),
        "time unreadable": F.col("instant").isNull(),
    })
    kept = losses.passed(E.with_split(kept.drop("time"), cohort), name, "of no stay in the cohort")
    is_text = dict(kept.dtypes)["value"] == "string"
    # Read before the first value is taken: a text in the aggregate would make it sort every row.
    number = S.to_number("value") if is_text else S.nan_to_null(F.col("value").cast("double"))
    firsts = E.first_per_instant(kept.withColumn("number", number), "instant", "seq", ["stay_id", "split"], "number")
    return losses.passed(firsts, name, "later value of the same instant").withColumn("block", F.lit(block))


def hourly_cells(
    cohort: DataFrame, labs: DataFrame | None, numerics: DataFrame | None, max_hours: int, max_null_share: float = 0.95,
    losses: Losses | None = None,
) -> DataFrame:
    """Labs and vitals on ceiled hours since the stay's first measurement.

    ``labs`` and ``numerics`` (either may be absent) are ``(stay_id, instant, feature, value, seq)``, lab values as text. Nearly always empty
    features and non-numeric values go before the first instant is taken; a text still counts as filled.
    """
    losses = losses or Losses()
    given = ((0, "labs", labs), (1, "numerics", numerics))
    firsts = E.union_series(*[first_values(part, cohort, i, losses, name) for i, name, part in given if part is not None])
    firsts = session.barrier(firsts, "ed_values")
    filled = select.not_sparse(firsts, "instant", max_null_share, ["block"], unique=True).drop("null_share")
    # Labs and vitals are one table from here on.
    numbers = losses.keep(firsts, "first values", {"no number": F.col("value").isNull()})
    both = select.keep_features(numbers, session.small(filled), ["block", "feature"])
    both = losses.passed(both, "first values", "feature nearly always empty")
    timed = timeaxis.anchor_to_first_event(both, "stay_id", "instant")
    binned = losses.keep(timed.withColumn("hour", S.ceil_bin("hours")), "first values", {"outside the window": ~timeaxis.inside(max_hours, closed=True)})
    cells = binned.groupBy("stay_id", "split", "hour", "feature").agg(
        F.avg("value").alias("value"), F.min("block").alias("block")
    )
    return cells.where(F.col("hour") < max_hours)


def patient_codes(
    cohort: DataFrame, visits: DataFrame, pmh: DataFrame, params: Preparation
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and rows per patient and code. The vocabulary counts rows of all valid patients, or of train ones."""
    coded = E.members(C.canonical(pmh, {"MRN": "subject_id", "Code": "code"}), visits, "subject_id")
    counts = session.barrier(K.subject_counts(coded), "subject_counts")
    fit = E.members(counts, common.train_of(cohort), "subject_id") if params.codes.fit_on == "train" else counts
    vocab = session.held(K.top_codes(K.total_counts(fit), params.codes.top_n))
    return vocab.withColumn("feature", F.concat(F.lit(params.codes.prefix), F.col("code"))), counts


def _series(
    table: DataFrame | None, time: str, name: str, value: str, formats: Sequence[str]
) -> DataFrame | None:
    """``(stay_id, time, instant, feature, value, seq)`` of a series table, if it is there."""
    if table is None:
        return None
    tables.require_columns(table, ["CSN", time, name, value, "seq"])
    return table.select(
        F.col("CSN").alias("stay_id"), F.col(time).alias("time"), S.to_time(time, *formats).alias("instant"),
        F.col(name).alias("feature"), F.col(value).alias("value"), "seq",
    )


def prepare(
    visits: DataFrame,
    labs: DataFrame | None = None,
    numerics: DataFrame | None = None,
    pmh: DataFrame | None = None,
    rads: DataFrame | None = None,
    params: Preparation = DEFAULTS,
    min_stay_hours: float = 0.0,
    encoder: R.Encoder | None = None,
    encoder_dim: int | None = None,
    static: bool = True,
    time_formats: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Each input may be absent. Texts in time columns are read by the first of ``time_formats`` that fits, after the
    standard form; ``losses`` counts those that none fits. ``labs`` and ``numerics`` carry their ingest order in ``seq`` (see ``sources.tables.with_file_order``)."""
    inputs = {"visits": visits, "labs": labs, "numerics": numerics, "pmh": pmh, "rads": rads}
    return spec.prepare(data_set(min_stay_hours, time_formats), inputs, params, static, encoder, encoder_dim)


def data_set(min_stay_hours: float = 0.0, time_formats: Sequence[str] = ()) -> spec.DataSet:
    def stays(given, params, losses):
        valid = visit_rows(given["visits"], params.labels.horizon_hours, losses)
        return losses.passed(C.min_stay(valid, "duration", min_stay_hours), "visits", "stay too short")

    def cells(given, cohort, params, losses):
        lab_rows = _series(given.get("labs"), "Result_time", "Component_name", "Component_value", time_formats)
        vital_rows = _series(given.get("numerics"), "Time", "Measure", "Value", time_formats)
        return hourly_cells(cohort, lab_rows, vital_rows, params.windows.max_hours, losses=losses)

    def codes(given, cohort, params):
        valid = visit_rows(given["visits"], params.labels.horizon_hours)
        vocabulary, counts = patient_codes(cohort, valid, given["pmh"], params)
        return spec.Codes(vocabulary, subject_counts=counts)

    def texts(given, cohort, params, losses):
        named = given["rads"].withColumnRenamed("CSN", "stay_id")
        named = losses.keep(named, "rads", {"no text": F.col("Study").isNull() | F.col("Impression").isNull()})
        own = E.members(R.report_text(named, "Study", "Impression"), cohort)
        return losses.passed(own, "rads", "of no stay in the cohort").select("stay_id", "text")

    return spec.DataSet(
        stays, STATIC, cells, ["labs", "numerics"], codes, "pmh", texts, "rads",
        {"visits": ["CSN", "MRN", "ED_LOS", "ED_dispo", *ED_REQUIRED]},
    )
