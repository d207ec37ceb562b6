"""Irregular measurements, kept long: ``(stay_id, hours or instant, feature, value)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cohortframe.functions import scalars as S

CELL = ["stay_id", "hour", "feature"]


SPLITS = ("train", "val", "test")


def members(df: DataFrame, cohort: DataFrame, key: str | list[str] = "stay_id") -> DataFrame:
    """Rows whose key is in the cohort. No DISTINCT: a semi join needs none, and AQE splits hot keys without it.

    A cohort too large to broadcast meets the rows by shuffle. The planner may then send a Bloom filter of the cohort's keys
    below the exchange of the rows, which it does only for a side that is filtered: that on the split lets every stay pass.
    """
    keys = [key] if isinstance(key, str) else key
    known = cohort.where(F.col("split").isin(*SPLITS)) if "split" in cohort.columns else cohort
    return df.join(known.select(*keys), keys, "left_semi")


def allow_items(df: DataFrame, items: Mapping[int, str], item: str = "itemid") -> DataFrame:
    """Keep listed items and name them. The list reaches the scan as a filter; nothing is joined."""
    return name_items(df.where(F.col(item).isin(*items)), items, item)


def name_items(df: DataFrame, items: Mapping[int, str], item: str = "itemid") -> DataFrame:
    return df.withColumn("feature", S.lookup(item, items))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def long_from_wide(df: DataFrame, ids: Sequence[str], columns: Sequence[str], keep_null: bool = False) -> DataFrame:
    """One row per measurement. With ``keep_null`` an empty reading still marks that its row existed."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    long = typed.unpivot(list(ids), list(columns), "feature", "value").withColumn("value", S.nan_to_null("value"))
    return long if keep_null else long.where(F.col("value").isNotNull())


def union_series(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column absent on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def mean_by(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def hourly_mean(events: DataFrame, keys: Sequence[str] = ("stay_id",)) -> DataFrame:
    """Mean per stay, started hour and feature. Partial means combine map-side, so a hot stay costs few rows."""
    return mean_by(events.withColumn("hour", S.hour_bin("hours")), [*keys, "hour", "feature"])


def with_split(cells: DataFrame, cohort: DataFrame) -> DataFrame:
    """Cells of cohort stays with the split of their stay."""
    return cells.join(cohort.select("stay_id", "split"), "stay_id")


def instant_then_hour_mean(events: DataFrame, instant: str = "instant") -> DataFrame:
    """Mean per instant first, then the unweighted mean of the instants of each hour."""
    binned = events.withColumn("hour", S.hour_bin("hours"))
    return mean_by(mean_by(binned, [*CELL, instant]), CELL)


def first_per_instant(
    events: DataFrame, instant: str, order: str, keys: Sequence[str] = ("stay_id",), taken: str = "value"
) -> DataFrame:
    """First non-null value in ingest order per stay, instant and feature.

    ``taken`` names what is returned of that row in place of the value. A number aggregates by hash, a text by sorting all rows.
    """
    return (
        events.where(F.col("value").isNotNull())
        .groupBy(*keys, instant, "feature")
        .agg(F.min_by(taken, order).alias("value"))
    )


def pivot_mean(df: DataFrame, keys: Sequence[str], features: Sequence[str], value: str = "value") -> DataFrame:
    """Wide table of means. The columns are given, so Spark needs no pass to find them.

    One aggregate by ``keys``; ``pivot`` would hash every key once with its feature and once more without.
    """
    return df.groupBy(*keys).agg(*[F.avg(F.when(F.col("feature") == F.lit(f), F.col(value))).alias(str(f)) for f in features])


def outer_join_hourly(tables: Sequence[DataFrame], keys: Sequence[str] = ("stay_id", "hour")) -> DataFrame:
    """Full outer join of wide hourly tables on (stay, hour)."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), tables)


def window_mean(
    hourly: DataFrame, window_hours: int, num_windows: int, keys: Sequence[str] = ("stay_id",)
) -> DataFrame:
    """Unweighted mean of hourly values per fixed window; hours outside the windows drop out."""
    return (
        hourly.withColumn("window", S.window_index("hour", window_hours))
        .where((F.col("window") >= 0) & (F.col("window") < num_windows))
        .groupBy(*keys, "window", "feature")
        .agg(F.avg("value").alias("value"))
    )
