"""Cohort selection: one row per stay, columns ``stay_id, subject_id, ...``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cohortframe.functions import scalars as S


def canonical(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename source keys and columns to the library's names."""
    return df.withColumnsRenamed(dict(names))


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "cohort") -> DataFrame:
    """``df``, or an error that names what it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks required columns: {missing}")
    return df


def numeric_text(df: DataFrame, column: str) -> DataFrame:
    """Turn text to a number and drop rows where it is none (``'> 89'``, blanks)."""
    return df.withColumn(column, S.to_number(column)).where(F.col(column).isNotNull())


def adults(df: DataFrame, age: str = "age", min_age: int = 18) -> DataFrame:
    return df.where(F.col(age) >= min_age)


def min_stay(df: DataFrame, hours: str, min_hours: float) -> DataFrame:
    return df.where(F.col(hours) >= min_hours)


def exclude_longer(df: DataFrame, hours: str, horizon: float) -> DataFrame:
    return df.where(F.col(hours) <= horizon)


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def map_outcome(df: DataFrame, source: str, mapping: Mapping, target: str = "event", default=None) -> DataFrame:
    """Category to code. Unlisted categories are dropped, or get ``default`` when one is given."""
    mapped = df.withColumn(target, S.lookup(source, mapping, default))
    return mapped if default is not None else mapped.where(F.col(target).isNotNull())


def first_stay(df: DataFrame, subject: str = "subject_id", time: str = "intime", tie: str = "stay_id") -> DataFrame:
    """Earliest stay of each patient. Spark limits each group before the shuffle, so a hot patient sends few rows."""
    order = Window.partitionBy(subject).orderBy(time, tie)
    return df.where(F.col(time).isNotNull()).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def stays_with_admissions(stays: DataFrame, patients: DataFrame, admissions: DataFrame) -> DataFrame:
    return stays.join(patients, "subject_id", "left").join(admissions, ["subject_id", "hadm_id"], "left")


def join_static(labels: DataFrame, static: DataFrame) -> DataFrame:
    """Stays that have both labels and static features."""
    shared = [c for c in static.columns if c in labels.columns and c != "stay_id"]
    return labels.join(static.drop(*shared), "stay_id", "inner")
