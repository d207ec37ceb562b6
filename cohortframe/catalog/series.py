"""Queries over irregular series."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import (
    CO, FEATURES, MAX_HOURS, NUM_WINDOWS, TS, WINDOW_HOURS, Tables, query, r6,
)
from cohortframe.functions import scalars as S
from cohortframe.operators import assemble, events as E, select, timeaxis
from cohortframe.operators.split import part_of, split_by_hash


@query(
    "hourly_mean",
    f"WITH {TS} SELECT stay_id, hour, feature, round(value, 6) AS value FROM hourly",
)
def hourly_mean(t: Tables):
    return t.hourly.select("stay_id", "hour", "feature", r6("value").alias("value"))


@query(
    "window_mean",
    f'WITH {TS} SELECT stay_id, win AS "window", feature, round(value, 6) AS value FROM windows',
)
def window_mean(t: Tables):
    return t.windows.select("stay_id", "window", "feature", r6("value").alias("value"))


@query(
    "two_stage_mean",
    f"""WITH {TS}, per_minute AS (
      SELECT stay_id, CAST(floor(hours) AS INTEGER) AS hour, feature, date_trunc('minute', ts) AS m, avg(value) AS value
      FROM inside GROUP BY 1, 2, 3, 4)
    SELECT stay_id, hour, feature, round(avg(value), 6) AS value FROM per_minute GROUP BY 1, 2, 3""",
)
def two_stage_mean(t: Tables):
    minutes = t.timed.withColumn("instant", F.date_trunc("minute", "ts"))
    return E.instant_then_hour_mean(minutes).withColumn("value", r6("value"))


@query(
    "first_per_instant",
    f"""WITH {TS} SELECT stay_id, CAST(floor(hours) AS INTEGER) AS hour, feature, arg_min(value, event_id) AS value
    FROM inside GROUP BY 1, 2, 3""",
)
def first_per_instant(t: Tables):
    return E.first_per_instant(t.timed.withColumn("hour", S.hour_bin("hours")), "hour", "event_id")


@query(
    "ceil_hour_bins",
    f"""WITH {TS} SELECT stay_id, CAST(ceil(hours) AS INTEGER) AS hour, feature, round(avg(value), 6) AS value
    FROM timed WHERE hours >= 0 AND hours <= {MAX_HOURS} AND ceil(hours) < {MAX_HOURS} GROUP BY 1, 2, 3""",
)
def ceil_hour_bins(t: Tables):
    timed = timeaxis.within(timeaxis.anchor_to_first_event(t.measurements), MAX_HOURS, closed=True)
    binned = timed.withColumn("hour", S.ceil_bin("hours")).where(F.col("hour") < MAX_HOURS)
    return E.mean_by(binned, E.CELL).withColumn("value", r6("value"))


_PIVOT = ", ".join(f"round(avg(value) FILTER (WHERE feature = '{f}'), 6) AS \"{f}\"" for f in FEATURES)


@query(
    "pivot_mean",
    f"WITH {TS} SELECT stay_id, CAST(floor(hours) AS INTEGER) AS hour, {_PIVOT} FROM inside GROUP BY 1, 2",
)
def pivot_mean(t: Tables):
    wide = E.pivot_mean(t.timed.withColumn("hour", S.hour_bin("hours")), ["stay_id", "hour"], FEATURES)
    return wide.select("stay_id", "hour", *[r6(f).alias(f) for f in FEATURES])


_BY_TYPE = [f"{f[0]} AS (SELECT stay_id, hour, value AS {f} FROM hourly WHERE feature = '{f}')" for f in FEATURES]
_OUTER = f"{FEATURES[0][0]} {' '.join(f'FULL JOIN {f[0]} USING (stay_id, hour)' for f in FEATURES[1:])}"


@query(
    "outer_join_hourly",
    f"""WITH {TS}, {", ".join(_BY_TYPE)} SELECT stay_id, hour, {", ".join(f"round({f}, 6) AS {f}" for f in FEATURES)} FROM {_OUTER}""",
)
def outer_join_hourly(t: Tables):
    """A wide hourly table for each of the event types, joined by stay and hour."""
    hourly = t.hourly

    def table(feature):
        return hourly.where(F.col("feature") == feature).select("stay_id", "hour", r6("value").alias(feature))

    return E.outer_join_hourly([table(f) for f in FEATURES])


@query(
    "union_by_name_mean",
    f"""WITH {TS} SELECT stay_id, CAST(floor(hours) AS INTEGER) AS hour,
      round(avg(value) FILTER (WHERE feature = 'click'), 6) AS click,
      round(avg(value) FILTER (WHERE feature IN ('view', 'purchase')), 6) AS view,
      round(avg(value) FILTER (WHERE feature = 'error'), 6) AS error,
      round(avg(value) FILTER (WHERE feature = 'signup'), 6) AS signup FROM inside GROUP BY 1, 2""",
)
def union_by_name_mean(t: Tables):
    """All event types, each in a table with columns of its own; two of them share one."""
    timed = t.timed.withColumn("hour", S.hour_bin("hours"))

    def table(feature, name):
        return timed.where(F.col("feature") == feature).select("stay_id", "hour", F.col("value").alias(name))

    union = E.union_series(*[table(f, "view" if f == "purchase" else f) for f in FEATURES])
    return union.groupBy("stay_id", "hour").agg(*[r6(F.avg(c)).alias(c) for c in ["click", "view", "error", "signup"]])


@query(
    "dense_grid",
    f'WITH {TS} SELECT stay_id, win AS "window", feature, round(value, 6) AS value FROM grid',
)
def dense_grid(t: Tables):
    grid = assemble.dense_grid(t.users, t.windows, FEATURES, NUM_WINDOWS)
    return grid.withColumn("value", r6("value"))


@query(
    "patient_events_to_stays",
    f"""WITH s AS (
      SELECT o_orderkey AS stay_id, o_custkey AS subject_id,
             TIMESTAMP '2024-01-01' + to_days(CAST(dayofyear(o_orderdate) % 30 AS INTEGER)) AS anchor_ts FROM orders),
    j AS (SELECT s.stay_id, e.event_id, (epoch_us(e.ts) - epoch_us(s.anchor_ts)) / 3.6e9 AS hours
          FROM events e JOIN s ON e.user_id = s.subject_id)
    SELECT stay_id, event_id, round(hours, 6) AS hours FROM j WHERE hours >= 0 AND hours < {MAX_HOURS}""",
)
def patient_events_to_stays(t: Tables):
    """Orders as stays of a customer, with the day of year folded into the month of the events."""
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(dayofyear(o_orderdate) % 30)")
    stays = t.read("orders").select(
        F.col("o_orderkey").alias("stay_id"), F.col("o_custkey").alias("subject_id"), start.alias("anchor_ts")
    )
    events = t.read("events").select(F.col("user_id").alias("subject_id"), "event_id", "ts")
    joined = timeaxis.fan_out_to_stays(events, stays, MAX_HOURS)
    return joined.select("stay_id", "event_id", r6("hours").alias("hours"))


@query(
    "anchored_from_admission",
    """WITH s AS (SELECT c_custkey AS stay_id, TIMESTAMP '2024-01-01' + to_days(c_nationkey) AS anchor_ts FROM customer),
    j AS (SELECT e.event_id, s.stay_id, (epoch_us(e.ts) - epoch_us(s.anchor_ts)) / 3.6e9 AS hours
          FROM events e JOIN s ON e.user_id = s.stay_id)
    SELECT event_id, stay_id, round(hours, 6) AS hours FROM j WHERE hours >= 0""",
)
def anchored_from_admission(t: Tables):
    """Stay-keyed events on the time axis of the stay, open-ended after its start."""
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(c_nationkey)")
    stays = t.read("customer").select(F.col("c_custkey").alias("stay_id"), start.alias("anchor_ts"))
    joined = timeaxis.within(timeaxis.anchor_to_stays(t.measurements.select("stay_id", "ts", "event_id"), stays))
    return joined.select("event_id", "stay_id", r6("hours").alias("hours"))


_ITEMS = {"click": "Tap", "view": "Look", "error": "Fault"}


@query(
    "item_allow_list",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'Tap' WHEN 'view' THEN 'Look' ELSE 'Fault' END AS feature, value
    FROM events WHERE event_type IN ('click', 'view', 'error')""",
)
def item_allow_list(t: Tables):
    return E.allow_items(t.read("events"), _ITEMS, "event_type").select("event_id", "feature", "value")


@query(
    "null_measurement_drop",
    f"""WITH {TS} SELECT event_id, stay_id, feature, value FROM inside WHERE value >= 5""",
)
def null_measurement_drop(t: Tables):
    """Values below 5 count as not measured."""
    nulled = t.timed.withColumn("value", F.when(F.col("value") >= 5, F.col("value")))
    return E.drop_missing(nulled, ["value"]).select("event_id", "stay_id", "feature", "value")


@query(
    "wide_vitals_to_long",
    f"WITH {TS} SELECT stay_id, hour, feature, round(value, 6) AS value FROM hourly WHERE value IS NOT NULL",
)
def wide_vitals_to_long(t: Tables):
    """A wide vital-sign table averaged per hour and unrolled; empty readings drop out."""
    wide = E.pivot_mean(t.timed.withColumn("hour", S.hour_bin("hours")), ["stay_id", "hour"], FEATURES)
    return E.long_from_wide(wide, ["stay_id", "hour"], FEATURES).withColumn("value", r6("value"))


_PRESENCE = {
    "rows": "(SELECT count(*) FROM (SELECT DISTINCT stay_id, hour FROM tr))",
    "grid": f"(SELECT count(*) * {MAX_HOURS} FROM users WHERE split = 'train')",
    "grid_nonempty": f"(SELECT count(DISTINCT stay_id) * {MAX_HOURS} FROM tr)",
}


@query(
    "feature_presence",
    f"WITH {TS}, tr AS (SELECT h.* FROM hourly h JOIN users u ON h.stay_id = u.stay_id WHERE u.split = 'train') "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS denominator, feature, count(value) AS observed, round(count(value) / {v}::DOUBLE, 6) AS presence "
        "FROM tr GROUP BY feature"
        for k, v in _PRESENCE.items()
    ),
)
def feature_presence(t: Tables):
    cells, train = session.barrier(split_by_hash(t.hourly, subject="stay_id"), "cells"), part_of(t.users, "train")
    tables = []
    for kind in _PRESENCE:
        rates = select.presence(cells, train, MAX_HOURS, kind)
        tables.append(rates.select(F.lit(kind).alias("denominator"), "feature", "observed", r6("presence").alias("presence")))
    return E.union_series(*tables)


@query(
    "sparse_feature_drop",
    f"""WITH {TS}, named AS (
      SELECT stay_id, ts, feature || CASE WHEN value > 30 THEN '_high' ELSE '' END AS feature, value FROM inside),
    n AS (SELECT count(*) AS n FROM (SELECT DISTINCT stay_id, ts FROM named)),
    kept AS (
      SELECT feature FROM (SELECT DISTINCT stay_id, ts, feature FROM named) GROUP BY feature
      HAVING 1 - count(*) / (SELECT n::DOUBLE FROM n) < 0.95)
    SELECT feature, count(*) AS n_values, round(avg(value), 6) AS mean FROM named
    WHERE feature IN (SELECT feature FROM kept) GROUP BY feature""",
)
def sparse_feature_drop(t: Tables):
    """High readings as features of their own, rare enough to be dropped; means of what stays."""
    high = F.when(F.col("value") > 30, "_high").otherwise("")
    named = t.timed.withColumn("feature", F.concat("feature", high)).withColumnRenamed("ts", "instant")
    kept = session.small(select.not_sparse(named).select("feature"))
    means = select.keep_features(named, kept).groupBy("feature")
    return means.agg(F.count("*").alias("n_values"), r6(F.avg("value")).alias("mean"))


@query(
    "cohort_membership",
    f"""WITH {CO} SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT stay_id FROM stays WHERE status = 'F' AND los_hours >= 24)""",
)
def cohort_membership(t: Tables):
    cohort = t.stays.where("status = 'F' AND los_hours >= 24").select(F.col("stay_id").alias("l_orderkey"))
    return E.members(t.read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), cohort, "l_orderkey")
