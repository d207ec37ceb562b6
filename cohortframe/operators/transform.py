"""Imputation and scaling with parameters fitted on the train part."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def static_means(static: DataFrame, train: DataFrame) -> DataFrame:
    """Train mean of each static feature over the stays that have it."""
    kept = static.join(train.select("stay_id"), "stay_id", "left_semi")
    return kept.groupBy("feature").agg(F.avg("value").alias("mean"))


def scaler_params(cells: DataFrame, train: DataFrame, num_windows: int, fit_on_observed: bool = False) -> DataFrame:
    """``(feature, mean, scale)`` on train windows, population deviation, scale 1 where a feature is constant.

    Missing windows count as zeros without being built: with m observed of n cells, observed mean u and variance v,
    the mean is u*m/n and the variance v*m/n + u^2 * m*(n-m)/n^2. ``fit_on_observed`` leaves the zeros out. ``cells``
    carry the ``split`` of their stay; ``train`` has the train stays.
    """
    kept = cells.where((F.col("split") == "train") & F.col("value").isNotNull())
    seen = kept.groupBy("feature").agg(
        F.count("*").alias("m"), F.avg("value").alias("u"), F.var_pop("value").alias("v")
    )
    if fit_on_observed:
        mean, variance = F.col("u"), F.col("v")
    else:
        n_cells = train.agg((F.count("*") * num_windows).cast("double")).scalar()
        seen = seen.withColumn("n", n_cells).withColumn("share", F.col("m") / F.col("n"))
        mean = F.col("u") * F.col("share")
        variance = F.col("v") * F.col("share") + F.col("u") * F.col("u") * F.col("share") * (1 - F.col("share"))
    scale = F.sqrt(variance)
    return seen.select("feature", mean.alias("mean"), F.when(scale > 1e-12, scale).otherwise(1.0).alias("scale"))


def scaled(cells: DataFrame, params: DataFrame) -> DataFrame:
    """Cells in units of the scaler. ``params`` has one row per feature; pass it through ``session.small``.

    A feature that train never saw was zero there throughout: mean 0, scale 1, so its cells stay as they are.
    """
    joined = cells.join(params, "feature", "left")
    value = (F.col("value") - F.coalesce("mean", F.lit(0.0))) / F.coalesce("scale", F.lit(1.0))
    return joined.withColumn("value", value).drop("mean", "scale")
