"""Summary tables: what the validation report and the plots are drawn from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.functions import scalars as S
from cohortframe.operators.running import quantile_of_counts, ranked

ALL_OUTCOMES = -1


def split_counts(cohort: DataFrame, measurements: DataFrame | None = None) -> DataFrame:
    """Stays and distinct patients per split, and the rows of ``measurements`` (by ``stay_id``) where given."""
    per_patient = cohort.groupBy("split", "subject_id").agg(F.count("*").alias("_n"))
    counts = per_patient.groupBy("split").agg(F.sum("_n").alias("n_stays"), F.count("subject_id").alias("n_patients"))
    if measurements is None:
        return counts
    rows = measurements.groupBy("stay_id").agg(F.count("*").alias("_m"))
    rows = cohort.select("stay_id", "split").join(rows, "stay_id").groupBy("split").agg(F.sum("_m").alias("_m"))
    joined = counts.join(rows, "split", "left")
    return joined.select("split", "n_stays", "n_patients", F.coalesce("_m", F.lit(0)).alias("n_measurements"))


#: log2 of the registers of a distinct-count sketch; the standard error is 1.04 / 2**(bits / 2), or 1.6 %.
SKETCH_BITS = 12


def split_sketches(cohort: DataFrame, column: str = "subject_id", bits: int = SKETCH_BITS) -> DataFrame:
    """``(split, n_stays, sketch)``: a mergeable HyperLogLog sketch of the distinct values per split.

    Keep the table of each run: sketches of several runs merge, where exact counts would need all rows again. Values of
    all types are taken as text. A sketch has a fixed size, whatever it counts, and combines map-side.
    """
    value = F.col(column).cast("string")
    return cohort.groupBy("split").agg(F.count("*").alias("n_stays"), F.hll_sketch_agg(value, F.lit(bits)).alias("sketch"))


def merge_sketches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """``(split, n_stays, sketch)`` over the tables of several runs."""
    every = reduce(lambda a, b: a.unionByName(b), others, first)
    return every.groupBy("split").agg(F.sum("n_stays").alias("n_stays"), F.hll_union_agg("sketch").alias("sketch"))


def approximate_counts(sketches: DataFrame, name: str = "n_patients") -> DataFrame:
    """``(split, n_stays, n_patients)`` with the estimated number of distinct values."""
    return sketches.select("split", "n_stays", F.hll_sketch_estimate("sketch").alias(name))


def outcome_distribution(labels: DataFrame, outcomes: Mapping[int, str]) -> DataFrame:
    """``(split, event, outcome, n, pct)`` with a row for every listed outcome, also an unseen one."""
    counts = labels.groupBy("split", "event").agg(F.count("*").alias("n"))
    listed = F.array(*[F.struct(F.lit(c).alias("event"), F.lit(o).alias("outcome")) for c, o in outcomes.items()])
    totals = counts.groupBy("split").agg(F.sum("n").alias("_all"))
    grid = totals.select("split", "_all", F.inline(listed))
    joined = grid.join(counts, ["split", "event"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    return joined.select("split", "event", "outcome", "n", S.percent("n", "_all").alias("pct"))


def duration_stats(labels: DataFrame) -> DataFrame:
    """Mean and exact median duration per split and outcome; ``event = -1`` is the whole split."""
    known = labels.where(F.col("duration").isNotNull())
    counts = known.groupBy("split", "event", "duration").agg(F.count("*").cast("double").alias("n"))
    both = counts.withColumn("event", F.explode(F.array(F.col("event"), F.lit(ALL_OUTCOMES))))
    both = both.groupBy("split", "event", "duration").agg(F.sum("n").alias("n"))
    means = both.groupBy("split", "event").agg(
        F.sum("n").cast("bigint").alias("n"), (F.sum(F.col("duration") * F.col("n")) / F.sum("n")).alias("mean")
    )
    medians = quantile_of_counts(both, "duration", "n", ["split", "event"])
    return means.join(medians.withColumnRenamed("quantile", "median"), ["split", "event"])


def missing_share(cells: DataFrame, cohort: DataFrame, num_windows: int, n_features: int) -> DataFrame:
    """Percent of unobserved tensor cells per split, from the observed cells alone."""
    size = float(num_windows * n_features)
    totals = cohort.groupBy("split").agg((F.count("*") * F.lit(size)).alias("_all"))
    seen = cells.where(F.col("value").isNotNull()).groupBy("stay_id").agg(F.count("*").alias("_seen"))
    seen = cohort.select("stay_id", "split").join(seen, "stay_id").groupBy("split").agg(F.sum("_seen").alias("observed"))
    observed = F.coalesce("observed", F.lit(0)).cast("bigint")
    joined = totals.join(seen, "split", "left").withColumn("observed", observed)
    return joined.select("split", "observed", (F.lit(100.0) - S.percent("observed", "_all")).alias("missing_pct"))


def vector_width(vectors: DataFrame, name: str = "embedding") -> Column:
    """Entries of the widest vector, as a scalar for ``shape_report``."""
    return vectors.agg(F.coalesce(F.max(F.size(name)), F.lit(0)).cast("int")).scalar()


def n_rows(table: DataFrame) -> Column:
    """Rows of a vocabulary, as a scalar for ``shape_report``."""
    return table.agg(F.count("*").cast("int")).scalar()


def shape_report(cohort: DataFrame, num_windows: int, structure: DataFrame, **extra: int | Column) -> DataFrame:
    """N, T and F per split with the dynamic and static parts and the width of further modalities, given or measured."""
    kinds = structure.agg(
        F.sum((F.col("kind") == "dynamic").cast("int")).cast("int").alias("n_dynamic"),
        F.sum((F.col("kind") == "static").cast("int")).cast("int").alias("n_static"),
    )
    counts = cohort.groupBy("split").agg(F.count("*").alias("n_stays")).withColumn("n_windows", F.lit(num_windows))
    counts = counts.withColumns(
        {"n_dynamic": kinds.select("n_dynamic").scalar(), "n_static": kinds.select("n_static").scalar()}
    )
    counts = counts.withColumn("n_features", F.col("n_dynamic") + F.col("n_static"))
    return counts.withColumns({name: width if isinstance(width, Column) else F.lit(width) for name, width in extra.items()})


def equal_width_bin(value, low, high, bins: int) -> Column:
    """Bin 0..bins-1 of an equal-width histogram whose last bin includes the upper end."""
    width = S.col(high) - S.col(low)
    position = F.try_divide((S.col(value) - S.col(low)) * F.lit(float(bins)), width)
    return F.coalesce(S.strict_least(F.floor(position), F.lit(bins - 1)), F.lit(0)).cast("int")


def _with_range(df: DataFrame, value: str) -> DataFrame:
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return df.withColumns({"_lo": ends.select("lo").scalar(), "_hi": ends.select("hi").scalar()})


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """``(by, bin, n)`` with a row for every bin of each group of ``by``, also an empty one."""
    known = _with_range(df.where(F.col(value).isNotNull()), value)
    binned = known.withColumn("bin", equal_width_bin(value, "_lo", "_hi", bins))
    counts = binned.groupBy(*by, "bin").agg(F.count("*").alias("n"))
    # One map per group has at most ``bins`` entries; the missing ones count nothing.
    packed = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"))
    each = packed.where(F.size("_n") > 0).select(*by, "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return each.select(*by, "bin", F.coalesce(F.try_element_at("_n", "bin"), F.lit(0)).cast("bigint").alias("n"))


def duration_histogram(labels: DataFrame, bins: int = 50) -> DataFrame:
    """Durations of censored stays (``has_event = 0``) and of stays with any event."""
    return histogram(labels.withColumn("has_event", S.indicator(F.col("event") > 0)), "duration", bins, ["has_event"])


def codes_per_stay(cohort: DataFrame, sums: DataFrame) -> DataFrame:
    """Every stay with its number of codes, 0 where ``sums`` (``stay_id, n_codes``) has none."""
    joined = cohort.select("stay_id").join(sums, "stay_id", "left")
    return joined.select("stay_id", F.coalesce(F.col("n_codes").cast("double"), F.lit(0.0)).alias("n_codes"))


def code_frequency(counts: DataFrame, top: int | None = None) -> DataFrame:
    """``(code, n)`` with the rank from 1: all codes, or the ``top`` most frequent. The ranking has a row per code."""
    best = counts if top is None else counts.orderBy(F.desc("n"), "code").limit(top)
    return ranked(best, [F.desc("n"), "code"])


def trajectory_stats(cells: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Mean and population deviation per (window, feature) over observed cells."""
    kept = cells if features is None else cells.join(features.select("feature"), "feature", "left_semi")
    return (
        kept.where(F.col("value").isNotNull())
        .groupBy("window", "feature")
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    )


def seeded_order(seed: int, *cs) -> Column:
    """Engine-independent pseudo-random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[S.col(c).cast("string") for c in cs]))


def sample_features(features: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """``k`` features drawn by a seeded hash."""
    return features.select("feature").orderBy(seeded_order(seed, "feature"), "feature").limit(k)


def vector_value_histogram(vectors: DataFrame, name: str = "embedding", bins: int = 50) -> DataFrame:
    """Histogram of all embedding values: one pass for the ends, one for the counts."""
    values = vectors.select(F.explode(name).alias("v")).select(F.col("v").cast("double").alias("v"))
    return histogram(values, "v", bins)
