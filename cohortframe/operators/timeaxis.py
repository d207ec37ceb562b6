"""Attach a start time to events and place them on the stay's own time axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S


def anchor_to_stays(
    events: DataFrame,
    stays: DataFrame,
    key: str | list[str] = "stay_id",
    time: str = "ts",
    anchor: str = "anchor_ts",
    how: str = "inner",
) -> DataFrame:
    """Add ``hours`` since the start of the stay; ``stays`` has one row per key.

    Both sides shuffle on the key unless Spark measures ``stays`` as small. AQE splits a hot key of the events if the
    shuffles of both sides feed the join directly, so pass a materialised table of stays, not an aggregate.
    """
    return events.join(stays, key, how).withColumn("hours", S.hours_between(anchor, time))


def fan_out_to_stays(
    events: DataFrame,
    stays: DataFrame,
    max_hours: float,
    key: str = "subject_id",
    time: str = "ts",
    anchor: str = "anchor_ts",
) -> DataFrame:
    """Patient-keyed events given to every stay of the patient that they fall into, ``0 <= hours < max_hours``.

    The join key carries a time bucket of ``max_hours``, so an event meets only stays that begin near it: never all
    events of a patient with all stays, and a hot patient spreads over the buckets. An event has one bucket and a
    stay two at most, so no pair appears twice.
    """
    width = F.lit(float(max_hours) * S.MICROS_PER_HOUR)
    bucketed_events = events.withColumn("_bucket", F.floor(S.micros(time) / width))
    first = F.floor(S.micros(anchor) / width)
    bucketed_stays = stays.where(F.col(anchor).isNotNull()).withColumn("_bucket", F.explode(F.array(first, first + 1)))
    joined = bucketed_events.join(bucketed_stays, [key, "_bucket"]).drop("_bucket")
    return within(joined.withColumn("hours", S.hours_between(anchor, time)), max_hours)


def first_event_times(events: DataFrame, key: str = "stay_id", time: str = "ts") -> DataFrame:
    return events.groupBy(key).agg(F.min(time).alias("anchor_ts"))


def anchor_to_first_event(events: DataFrame, key: str = "stay_id", time: str = "ts") -> DataFrame:
    """Add ``hours`` since the first event of the stay.

    The minimum combines map-side, where a window would sort each stay. It is written once: joined to the aggregate
    itself, a hot stay could not be split.
    """
    return anchor_to_stays(events, session.barrier(first_event_times(events, key, time), "first_event"), key, time)


def inside(max_hours: float | None = None, hours: str | Column = "hours", closed: bool = False) -> Column:
    """``0 <= hours < max_hours``; ``closed`` keeps the end point, no ``max_hours`` leaves the window open."""
    hours = S.col(hours)
    if max_hours is None:
        return hours >= 0
    return (hours >= 0) & (hours <= max_hours if closed else hours < max_hours)


def within(df: DataFrame, max_hours: float | None = None, hours: str = "hours", closed: bool = False) -> DataFrame:
    """Rows ``inside`` the window."""
    return df.where(inside(max_hours, hours, closed))
