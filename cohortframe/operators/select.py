"""Feature selection by how often a feature is observed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _presence_denominator(train_cells: DataFrame, stays: DataFrame, max_hours: int, denominator: str) -> Column:
    if denominator == "rows":
        return train_cells.select("stay_id", "hour").distinct().agg(F.count("*").cast("double")).scalar()
    if denominator == "grid":
        return stays.agg((F.count("*") * max_hours).cast("double")).scalar()
    if denominator == "grid_nonempty":
        return train_cells.select("stay_id").distinct().agg((F.count("*") * max_hours).cast("double")).scalar()
    raise ValueError(f"unknown denominator {denominator!r}")


def presence(
    cells: DataFrame, train: DataFrame, max_hours: int, denominator: str = "rows", extra: Sequence[Column] = ()
) -> DataFrame:
    """Share of hourly cells observed per feature in train, for every feature of ``cells``.

    ``cells`` carry the ``split`` of their stay, so nothing is joined; ``train`` has the train stays. ``rows`` counts the
    (stay, hour) rows that exist, ``grid`` all hours of all stays, ``grid_nonempty`` all hours of stays with any row. A
    cell with a NULL value marks an existing but unobserved row. ``extra`` aggregates ride along.
    """
    in_train = F.col("split") == "train"
    counts = cells.groupBy("feature").agg(F.count(F.when(in_train, F.col("value"))).alias("observed"), *extra)
    total = counts.withColumn("total", _presence_denominator(cells.where(in_train), train, max_hours, denominator))
    return total.withColumn("presence", F.try_divide("observed", "total"))


def dense_enough(rates: DataFrame, threshold: float) -> DataFrame:
    return rates.where(F.col("presence") >= threshold).drop("observed", "total", "presence")


def not_sparse(
    events: DataFrame,
    instant: str = "instant",
    max_null_share: float = 0.95,
    by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Features whose NULL share over the (stay, instant) rows is below ``max_null_share``, per source ``by``.

    ``unique`` tells that events are already one row per stay, instant and feature.
    """
    by = list(by)
    filled = events if unique else events.select(*by, "stay_id", instant, "feature").distinct()
    filled = filled.groupBy(*by, "feature").agg(F.count("*").alias("filled"))
    instants = events.select(*by, "stay_id", instant).distinct().groupBy(*by).agg(F.count("*").alias("n_instants"))
    if by:
        rates = filled.join(instants, by)
    else:
        rates = filled.withColumn("n_instants", instants.scalar())
    rates = rates.withColumn("null_share", F.lit(1.0) - F.col("filled") / F.col("n_instants"))
    return rates.where(F.col("null_share") < max_null_share).select(*by, "feature", "null_share")


def keep_features(cells: DataFrame, kept: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Cells of kept features. Pass ``kept`` through ``session.small`` so a checked-size list is broadcast."""
    return cells.join(kept, list(keys), "left_semi")
