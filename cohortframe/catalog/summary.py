"""Queries that summarise cohorts, labels and tensors."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import (
    FEATURES, LABELS, NUM_WINDOWS, OUTCOMES, ST, TS, Tables, query, r6,
)
from cohortframe.catalog.statics import _LEVELS, CATEGORIES
from cohortframe.functions import scalars as S
from cohortframe.operators import assemble, codes as K, report, static as static_ops

_NAMES = ", ".join(f"({k}, '{v}')" for k, v in OUTCOMES.items())


@query(
    "outcome_distribution",
    f"""WITH {LABELS}, o(event, outcome) AS (VALUES {_NAMES}),
    n AS (SELECT split, event, count(*) AS n FROM labels GROUP BY 1, 2), tot AS (SELECT split, sum(n) AS a FROM n GROUP BY 1)
    SELECT tot.split, CAST(o.event AS INTEGER) AS event, outcome, CAST(coalesce(n, 0) AS BIGINT) AS n,
      round(coalesce(n, 0) * 100.0::DOUBLE / a, 6) AS pct
    FROM tot CROSS JOIN o LEFT JOIN n ON n.split = tot.split AND n.event = o.event""",
)
def outcome_distribution(t: Tables):
    return report.outcome_distribution(t.labels, OUTCOMES).withColumn("pct", r6("pct"))


@query(
    "percent_columns",
    f"""WITH {LABELS} SELECT split, round(count(*) FILTER (WHERE event > 0) * 100.0::DOUBLE / count(*), 6) AS event_rate,
      round(count(*) FILTER (WHERE event = 0) * 100.0::DOUBLE / count(*), 6) AS censoring_rate FROM labels GROUP BY 1""",
)
def percent_columns(t: Tables):
    counts = t.labels.groupBy("split").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("event") > 0, 1)).alias("events"),
        F.count(F.when(F.col("event") == 0, 1)).alias("censored"),
    )
    return counts.select(
        "split",
        r6(S.percent("events", "n")).alias("event_rate"),
        r6(S.percent("censored", "n")).alias("censoring_rate"),
    )


@query(
    "duration_stats",
    f"""WITH {LABELS} SELECT split, CAST(coalesce(event, -1) AS INTEGER) AS event, count(*) AS n, round(avg(duration), 6) AS mean,
      round(median(duration), 6) AS median FROM labels GROUP BY GROUPING SETS ((split, event), (split))""",
)
def duration_stats(t: Tables):
    return report.duration_stats(t.labels).withColumns({"mean": r6("mean"), "median": r6("median")})


@query(
    "split_counts",
    f"""WITH {LABELS}, m AS (SELECT split, count(*) AS n FROM labels JOIN lineitem ON l_orderkey = stay_id GROUP BY 1)
    SELECT split, count(*) AS n_stays, count(DISTINCT subject_id) AS n_patients, coalesce(max(n), 0) AS n_measurements
    FROM labels LEFT JOIN m USING (split) GROUP BY 1""",
)
def split_counts(t: Tables):
    """Stays, patients and line items (as measurements) per split."""
    return report.split_counts(t.labels, t.read("lineitem").select(F.col("l_orderkey").alias("stay_id")))


@query(
    "mask_long",
    f"""WITH {TS} SELECT stay_id, win AS "window", feature, CAST(CASE WHEN value IS NULL THEN 0 ELSE 1 END AS FLOAT) AS mask
    FROM grid""",
)
def mask_long(t: Tables):
    grid = assemble.dense_grid(t.users, t.windows, FEATURES, NUM_WINDOWS)
    return grid.select("stay_id", "window", "feature", F.col("value").isNotNull().cast("float").alias("mask"))


@query(
    "missing_share",
    f"""WITH {TS} SELECT split, count(value) AS observed, round(100.0::DOUBLE - count(value) * 100.0::DOUBLE / count(*), 6)
      AS missing_pct FROM grid GROUP BY 1""",
)
def missing_share(t: Tables):
    shares = report.missing_share(t.windows, t.users, NUM_WINDOWS, len(FEATURES))
    return shares.withColumn("missing_pct", r6("missing_pct"))


_STRUCTURE = f"""{_LEVELS},
order_ AS (SELECT 'static' AS kind, 'balance' AS feature, 1 AS a, 0 AS b, 0 AS k UNION ALL SELECT 'static', feature, 1, ci, k FROM vocab
  UNION ALL SELECT 'dynamic', feature, 0, 0, 0 FROM features),
structure AS (SELECT feature, kind, CAST(row_number() OVER (ORDER BY a, b, k, feature) - 1 AS INTEGER) AS idx FROM order_)"""


def _structure(t: Tables):
    levels = static_ops.level_vocabulary(t.customers, CATEGORIES)
    vocab = static_ops.static_vocabulary(levels, ["balance"], CATEGORIES)
    dynamic = t.hourly.select("feature").distinct().withColumns({"block": F.lit(0), "position": F.lit(0)})
    return assemble.feature_structure(dynamic, vocab)


@query("feature_structure", f"WITH {TS}, {ST}, {_STRUCTURE} SELECT feature, kind, idx FROM structure")
def feature_structure(t: Tables):
    return _structure(t)


@query(
    "shape_report",
    f"""WITH {TS}, {ST}, {_STRUCTURE}, k AS (
      SELECT CAST(count(*) FILTER (WHERE kind = 'dynamic') AS INTEGER) AS d, CAST(count(*) FILTER (WHERE kind = 'static') AS INTEGER) AS s
      FROM structure)
    SELECT split, count(*) AS n_stays, CAST({NUM_WINDOWS} AS INTEGER) AS n_windows, max(d) AS n_dynamic, max(s) AS n_static,
      max(d + s) AS n_features,
      (SELECT CAST(count(DISTINCT p_brand) AS INTEGER) FROM lineitem JOIN part ON l_partkey = p_partkey) AS n_codes,
      (SELECT CAST(max(len(embedding)) AS INTEGER) FROM embeddings) AS n_report FROM users, k GROUP BY 1""",
)
def shape_report(t: Tables):
    codes = session.held(K.top_codes(K.code_counts(t.coded), 500))
    return report.shape_report(
        t.users, NUM_WINDOWS, session.small(_structure(t)), n_codes=report.n_rows(codes), n_report=report.vector_width(t.vectors)
    )


@query(
    "approximate_split_counts",
    f"""WITH {LABELS} SELECT split, count(*) AS n_stays, count(DISTINCT subject_id) AS n_patients, true AS within FROM labels GROUP BY 1""",
)
def approximate_split_counts(t: Tables):
    """Sketches of two runs, merged, against the exact number of patients: within three standard errors."""
    labels = session.barrier(t.labels, "labels")
    runs = [report.split_sketches(labels.where(F.col("stay_id") % 2 == i)) for i in (0, 1)]
    exact = report.split_counts(labels).select("split", F.col("n_patients").alias("exact"))
    both = report.approximate_counts(report.merge_sketches(*runs)).join(exact, "split")
    error = 3 * 1.04 / 2 ** (report.SKETCH_BITS / 2)
    return both.select("split", "n_stays", F.col("exact").alias("n_patients"), (F.abs(F.col("n_patients") - F.col("exact")) <= error * F.col("exact")).alias("within"))


@query(
    "duration_histogram",
    f"""WITH {LABELS}, r AS (SELECT min(duration) AS lo, max(duration) AS hi FROM labels),
    c AS (SELECT CAST(event > 0 AS INTEGER) AS has_event, CAST(least(floor((duration - lo) * 50.0 / (hi - lo)), 49) AS INTEGER) AS bin,
      count(*) AS n FROM labels, r GROUP BY 1, 2),
    g AS (SELECT has_event, CAST(range AS INTEGER) AS bin FROM (SELECT DISTINCT has_event FROM c), range(50))
    SELECT has_event, bin, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (has_event, bin)""",
)
def duration_histogram(t: Tables):
    return report.duration_histogram(session.barrier(t.labels, "labels"))


@query(
    "trajectory_stats",
    f"""WITH {TS} SELECT win AS "window", feature, count(*) AS n, round(avg(value), 9) AS mean, round(stddev_pop(value), 6) AS std
    FROM windows GROUP BY 1, 2""",
)
def trajectory_stats(t: Tables):
    return report.trajectory_stats(t.windows).withColumns({"mean": F.round("mean", 9), "std": r6("std")})


@query(
    "sample_features",
    "SELECT feature FROM (SELECT DISTINCT event_type AS feature FROM events) ORDER BY md5('42|' || feature), feature LIMIT 3",
)
def sample_features(t: Tables):
    features = t.read("events").select(F.col("event_type").alias("feature")).distinct()
    return report.sample_features(features, 3)
