"""Stand-alone reshapes of raw tables into per-stay tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.functions.fixed import PREP_OUTCOMES
from cohortframe.operators import codes as K, cohort as C, events as E, reports as R, static as static_ops, timeaxis


def ed_labels(edstays: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``(stay_id, ed_los_hours, outcome)``; unlisted or missing dispositions count as censored."""
    los = edstays.select("stay_id", S.hours_between("intime", "outtime").alias("ed_los_hours"))
    joined = los.join(outcomes.select("stay_id", "disposition"), "stay_id", "left")
    return C.map_outcome(joined, "disposition", PREP_OUTCOMES, "outcome", default=0).drop("disposition")


def ed_static(
    patients: DataFrame, edstays: DataFrame, categorical: Sequence[str] = ("gender", "race", "insurance")
) -> tuple[DataFrame, DataFrame]:
    """Long demographics per stay with age, levels without the first of each column, and the level vocabulary."""
    joined = edstays.select("stay_id", "subject_id").join(patients, "subject_id", "left")
    joined = C.canonical(joined, {"anchor_age": "age"})
    present = [c for c in categorical if c in joined.columns]
    vocabulary = session.small(static_ops.level_vocabulary(joined, present, drop_first=True), name="levels")
    numeric = [c for c in joined.columns if c not in ("stay_id", "subject_id", *present)]
    rows = static_ops.numeric_features(joined, numeric).unionByName(static_ops.one_hot(joined, present, vocabulary))
    return rows, vocabulary


def ed_series(vitals: DataFrame, labs: DataFrame, edstays: DataFrame) -> DataFrame:
    """Wide vitals and labs on one hour axis from arrival; readings of the same moment are averaged."""
    anchors = edstays.select("stay_id", F.col("intime").alias("anchor_ts")).distinct()

    def charted(df: DataFrame) -> DataFrame:
        return df.drop("subject_id").withColumn("charttime", F.col("charttime").cast("timestamp"))

    # One join for both: a join each would be two sets of sorts in the task of their union.
    joined = timeaxis.anchor_to_stays(E.union_series(charted(vitals), charted(labs)), anchors, "stay_id", "charttime", how="left")
    both = timeaxis.within(joined).drop("charttime", "anchor_ts").withColumnRenamed("hours", "time_hours")
    values = [c for c in both.columns if c not in ("stay_id", "time_hours")]
    return both.groupBy("stay_id", "time_hours").agg(*[F.avg(c).alias(c) for c in values])


def ed_codes(diagnoses: DataFrame, top_n: int) -> tuple[DataFrame, DataFrame]:
    """Vocabulary over all rows and the binary cells of stays that have any of its codes."""
    coded = diagnoses.withColumnRenamed("icd_code", "code")
    vocab = session.held(K.top_codes(K.code_counts(coded), top_n))
    return vocab, K.code_cells(coded.select("stay_id", "code"), vocab)


def ed_reports(texts: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
    return R.intake_vectors(texts, embeddings)


def item_series(item_events: DataFrame, admissions: DataFrame, items: Mapping[int, str]) -> DataFrame:
    """Wide means per admission and hour since admission, one column per listed item."""
    listed = E.allow_items(item_events, items)
    anchors = admissions.select("hadm_id", F.col("admittime").alias("anchor_ts"))
    timed = timeaxis.within(timeaxis.anchor_to_stays(listed, anchors, "hadm_id", "charttime"))
    return E.pivot_mean(timed.withColumnRenamed("hours", "time_hours"), ["hadm_id", "time_hours"],
                        sorted(set(items.values())), "valuenum")
