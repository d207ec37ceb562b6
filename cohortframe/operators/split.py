"""Train/val/test assignment. Every stay of a patient lands in the same part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.functions import scalars as S
from cohortframe.operators.running import running, sized, with_total
from cohortframe.params import Split


def _hash_number(c, seed: int) -> Column:
    """First thirteen hex digits of the seeded md5 as a whole number below 2^52."""
    text = F.md5(F.concat(F.lit(f"{seed}|"), S.col(c).cast("string")))
    return F.conv(F.substring(text, 1, 13), 16, 10).cast("bigint")


def split_by_hash(df: DataFrame, split: Split = Split(), subject: str = "subject_id") -> DataFrame:
    """Add ``split`` from a seeded hash of the patient: no shuffle, stable when patients are added; sizes approximate."""
    part = S.hash_fraction_hex(subject, split.seed)
    return df.withColumn(
        "split",
        F.when(part < S.share_as_hex(split.train), "train")
        .when(part < S.share_as_hex(split.train + split.val), "val")
        .otherwise("test"),
    )


def split_exact(df: DataFrame, split: Split = Split(), subject: str = "subject_id") -> DataFrame:
    """Add ``split`` with exact patient counts: the held-out share is rounded up, then the test share of it."""
    hashes = df.select(subject).distinct().withColumn("_h", _hash_number(subject, split.seed))
    counts, biggest = sized(hashes.groupBy("_h").agg(F.count("*").cast("double").alias("_n")))
    ranked = with_total(running(counts, "_h", sums=["_n"], ticks=F.col("_h"), biggest=biggest), counts, "_n")
    total = F.col("_total")
    held = F.ceil(F.round(total * (split.val + split.test), 6))
    share = split.test / (split.val + split.test) if split.val + split.test > 0 else 0.0
    test = F.ceil(F.round(held * share, 6))
    parts = ranked.select(
        "_h",
        F.when(F.col("run__n") <= total - held, "train").when(F.col("run__n") <= total - test, "val")
        .otherwise("test").alias("split"),
    )
    return df.withColumn("_h", _hash_number(subject, split.seed)).join(parts, "_h").drop("_h")


def assign_split(df: DataFrame, split: Split = Split(), subject: str = "subject_id") -> DataFrame:
    return split_exact(df, split, subject) if split.exact else split_by_hash(df, split, subject)


def stratified_split(
    df: DataFrame, stratum: str = "event", unit: str = "stay_id", test: float = 0.2, seed: int = 42
) -> DataFrame:
    """Stay-level train/test split with the same test share in every stratum, ranked by hash.

    Ranks come from running counts over the hash, since one stratum may hold most stays.
    """
    hashed = df.withColumn("_h", _hash_number(unit, seed))
    counts, biggest = sized(hashed.groupBy(stratum, "_h").agg(F.count("*").cast("double").alias("_n")), [stratum])
    ranked = running(counts, "_h", [stratum], sums=["_n"], ticks=F.col("_h"), biggest=biggest)
    held = F.ceil(F.round(F.col("_total") * test, 6))
    parts = with_total(ranked, counts, "_n", [stratum]).select(
        stratum, "_h", F.when(F.col("run__n") <= F.col("_total") - held, "train").otherwise("test").alias("split")
    )
    return hashed.join(parts, [stratum, "_h"]).drop("_h")


def part_of(df: DataFrame, name: str) -> DataFrame:
    """One part of a split; the sink partitions by this column, so a read of it prunes."""
    return df.where(F.col("split") == name)
