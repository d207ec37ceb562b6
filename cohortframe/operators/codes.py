"""Diagnosis codes: history of a stay, vocabulary, multi-hot and count vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortframe.functions import scalars as S
from cohortframe.operators.running import running, sized, with_total


def restrict_codes(coded: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows whose code is in the vocabulary. A held top-n vocabulary is small by its measured size, so it is broadcast."""
    return coded.join(vocabulary.select("code"), "code", "left_semi")


def code_records(coded: DataFrame) -> DataFrame:
    """``(subject_id, code, coded_ts, n)``: records of the same patient, code and time as one row."""
    return coded.groupBy("subject_id", "code", "coded_ts").agg(F.count("*").cast("double").alias("n"))


def past_codes(stays: DataFrame, coded: DataFrame) -> DataFrame:
    """Distinct ``(stay_id, code)`` of codes the patient got strictly before the stay began.

    A code counts for a stay exactly if the patient's first record of it lies before, so records shrink to one row per
    patient and code before the join; records and stays of a patient are never paired off. Restrict ``coded`` to the
    vocabulary first, which bounds the join by stays x vocabulary.
    """
    first = coded.groupBy("subject_id", "code").agg(F.min("coded_ts").alias("first_ts"))
    early = F.col("first_ts") < F.col("anchor_ts")
    return stays.join(first, "subject_id").where(early).select("stay_id", "code")


def current_code_counts(stays: DataFrame, coded: DataFrame, *carried: str) -> DataFrame:
    """``(stay_id, *carried, code, n)``: rows per code of the stay's own admission; ``carried`` are columns of the stays.

    Such codes are assigned at discharge, so they know the outcome.
    """
    own = coded.groupBy("subject_id", "hadm_id", "code").agg(F.count("*").alias("n"))
    joined = stays.select("stay_id", "subject_id", "hadm_id", *carried).join(own, ["subject_id", "hadm_id"])
    return joined.select("stay_id", *carried, "code", "n")


def current_codes(stays: DataFrame, coded: DataFrame) -> DataFrame:
    """Distinct ``(stay_id, code)`` of the stay's own admission."""
    return current_code_counts(stays, coded).select("stay_id", "code")


def past_code_counts(stays: DataFrame, records: DataFrame) -> DataFrame:
    """``(code, n)``: past ``code_records`` per code, summed over stays, without pairing records and stays.

    A record counts once for each later stay of the patient. The number of stays up to a time is a running count on
    the patient's time line of distinct times; the rest of the patient's stays come later. Restrict the records to the
    cohort's patients first.
    """
    starts = stays.where(F.col("anchor_ts").isNotNull()).select("subject_id", S.micros("anchor_ts").alias("at"))
    timed = records.where(F.col("coded_ts").isNotNull()).select("subject_id", S.micros("coded_ts").alias("at"), "code", "n")
    line = starts.withColumn("stays", F.lit(1.0)).unionByName(
        timed.select("subject_id", "at", F.lit(0.0).alias("stays"))
    )
    line, biggest = sized(line.groupBy("subject_id", "at").agg(F.sum("stays").alias("stays")), ["subject_id"], "line")
    counted = running(line, "at", ["subject_id"], sums=["stays"], ticks=F.col("at"), biggest=biggest)
    later = with_total(counted, line, "stays", ["subject_id"]).select(
        "subject_id", "at", (F.col("_total") - F.col("run_stays")).alias("later")
    )
    pairs = timed.join(later.where("later > 0"), ["subject_id", "at"])
    return pairs.groupBy("code").agg(F.sum(F.col("n") * F.col("later")).cast("bigint").alias("n"))


def first_records(coded: DataFrame) -> DataFrame:
    """``code_records`` of the first time a patient got each code, counted once."""
    first = coded.groupBy("subject_id", "code").agg(F.min("coded_ts").alias("coded_ts"))
    return first.withColumn("n", F.lit(1.0))


def past_code_sums(stays: DataFrame, coded: DataFrame) -> DataFrame:
    """``(stay_id, n_codes)``: distinct codes the patient got strictly before the stay, as running counts of first records."""
    starts = stays.where(F.col("anchor_ts").isNotNull()).select("stay_id", "subject_id", S.micros("anchor_ts").alias("at"))
    firsts = first_records(coded).where(F.col("coded_ts").isNotNull())
    line = firsts.select("subject_id", S.micros("coded_ts").alias("at"), F.lit(1.0).alias("codes"))
    line = line.unionByName(starts.select("subject_id", "at", F.lit(0.0).alias("codes")))
    line, biggest = sized(line.groupBy("subject_id", "at").agg(F.sum("codes").alias("codes")), ["subject_id"], "line")
    counted = running(line, "at", ["subject_id"], sums=["codes"], ticks=F.col("at"), biggest=biggest)
    before = counted.select("subject_id", "at", (F.col("run_codes") - F.col("codes")).alias("n_codes"))
    return starts.join(before, ["subject_id", "at"]).select("stay_id", "n_codes")


def code_counts(coded: DataFrame) -> DataFrame:
    """``(code, n)``: plain row counts."""
    return coded.groupBy("code").agg(F.count("*").alias("n"))


def top_codes(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent codes with their rank from 0; ties go by code. Ranking sees n rows only."""
    top = counts.where(F.col("code").isNotNull()).orderBy(F.desc("n"), "code").limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "code")) - 1
    return top.select("code", "n", rank.cast("int").alias("code_idx"))


def code_cells(stay_codes: DataFrame, vocabulary: DataFrame, value: str = "binary") -> DataFrame:
    """``(stay_id, pos, value)``: presence or row count of each vocabulary code."""
    placed = stay_codes.join(vocabulary.select("code", F.col("code_idx").alias("pos")), "code")
    counted = placed.groupBy("stay_id", "pos").agg(F.count("*").cast("double").alias("value"))
    return counted if value == "count" else counted.withColumn("value", F.lit(1.0))


def subject_counts(coded: DataFrame) -> DataFrame:
    """``(subject_id, code, n)``: rows per patient and code."""
    return coded.groupBy("subject_id", "code").agg(F.count("*").alias("n"))


def total_counts(counts: DataFrame) -> DataFrame:
    """``(code, n)`` from counts per patient."""
    return counts.groupBy("code").agg(F.sum("n").alias("n"))


def vector_per_subject(
    cohort: DataFrame, counts: DataFrame, vocabulary: DataFrame, size: int, name: str, value: str = "count"
) -> DataFrame:
    """``cohort`` with the dense vector of its patient's ``subject_counts``; zeros throughout for a patient without any.

    The vector is built once per patient, so the join moves patients x codes and not stays x codes.
    """
    slots = vocabulary.select("code", F.col("code_idx").alias("pos"))
    number = F.col("n").cast("double") if value == "count" else F.lit(1.0)
    placed = counts.join(slots, "code").select("subject_id", "pos", number.alias("value"))
    packed = placed.groupBy("subject_id").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_cells"))
    dense = packed.select("subject_id", S.scatter("_cells", size, F.lit(0.0)).cast("array<float>").alias("_dense"))
    zeros = F.array_repeat(F.lit(0.0).cast("float"), size)
    return cohort.join(dense, "subject_id", "left").withColumn(name, F.coalesce("_dense", zeros)).drop("_dense")


def vector_per_stay(cohort: DataFrame, cells: DataFrame, size: int, name: str, default: float = 0.0) -> DataFrame:
    """Every cohort stay with a dense vector; a stay without cells gets ``default`` throughout."""
    packed = cells.groupBy("stay_id").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_cells"))
    dense = S.scatter("_cells", size, F.lit(default)).cast("array<float>")
    return cohort.join(packed, "stay_id", "left").withColumn(name, dense).drop("_cells")
