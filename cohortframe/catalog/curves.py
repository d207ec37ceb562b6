"""Queries over survival curves and time bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import LABELS, Tables, query, r6
from cohortframe.operators import survival, timeaxis
from cohortframe.operators.split import part_of

_KM = """
c AS (SELECT duration AS time, count(*)::DOUBLE AS n, sum(CAST(event = 1 AS INTEGER))::DOUBLE AS d FROM labels GROUP BY 1),
r AS (SELECT *, sum(n) OVER (ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM c),
km AS (
  SELECT time, at_risk, d, product(1 - d / at_risk) OVER (ORDER BY time) AS survival,
         sum(CASE WHEN at_risk > d THEN d / (at_risk * (at_risk - d)) ELSE 0 END) OVER (ORDER BY time) AS greenwood FROM r)"""


@query(
    "km_curve",
    f"""WITH {LABELS}, {_KM} SELECT time, at_risk::DOUBLE AS at_risk, d, round(survival, 6) AS survival, round(greenwood, 9)
      AS greenwood FROM km""",
)
def km_curve(t: Tables):
    curve = survival.km_curve(t.single_risk)
    return curve.withColumns({"survival": r6("survival"), "greenwood": F.round("greenwood", 9)})


@query(
    "km_curve_by_split",
    f"""WITH {LABELS},
    c AS (SELECT split, duration AS time, count(*)::DOUBLE AS n, sum(CAST(event = 1 AS INTEGER))::DOUBLE AS d FROM labels GROUP BY 1, 2),
    r AS (SELECT *, sum(n) OVER (PARTITION BY split ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            AS at_risk FROM c)
    SELECT split, time, at_risk::DOUBLE AS at_risk, round(product(1 - d / at_risk) OVER (PARTITION BY split ORDER BY time), 6)
      AS survival FROM r""",
)
def km_curve_by_split(t: Tables):
    return survival.km_curve(t.single_risk, ["split"]).select("split", "time", "at_risk", r6("survival").alias("survival"))


@query(
    "km_curve_fine",
    """WITH f AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY 1),
    labels AS (SELECT (epoch_us(ts) - epoch_us(t0)) / 3.6e9 AS duration, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS event
      FROM events e JOIN f ON e.user_id = f.user_id), """
    + _KM
    + """ SELECT round(time, 6) AS time, at_risk::DOUBLE AS at_risk, round(survival, 6) AS survival FROM km""",
)
def km_curve_fine(t: Tables):
    """A curve with nearly as many distinct microsecond times as rows: time of every event since the user's first."""
    labels = timeaxis.anchor_to_first_event(t.measurements).select(
        F.col("hours").alias("duration"), (F.col("feature") == "error").cast("int").alias("event")
    )
    curve = survival.km_curve(labels)
    return curve.select(r6("time").alias("time"), "at_risk", r6("survival").alias("survival"))


_Z = 1.959963984540054


@query(
    "km_band",
    f"""WITH {LABELS}, {_KM}, b AS (SELECT time, survival, CASE WHEN survival > 0 AND survival < 1
        THEN {_Z} * sqrt(greenwood) / ln(survival) END AS spread FROM km)
    SELECT time, round(survival, 6) AS survival,
      round(CASE WHEN survival >= 1 THEN 1.0 ELSE exp(-exp(ln(-ln(CASE WHEN survival > 0 AND survival < 1 THEN survival END)) - spread)) END, 6) AS lower,
      round(CASE WHEN survival >= 1 THEN 1.0 ELSE exp(-exp(ln(-ln(CASE WHEN survival > 0 AND survival < 1 THEN survival END)) + spread)) END, 6) AS upper
    FROM b""",
)
def km_band(t: Tables):
    band = survival.km_band(survival.km_curve(t.single_risk))
    return band.select("time", *[r6(c).alias(c) for c in ["survival", "lower", "upper"]])


_AJ = """
c AS (SELECT duration AS time, count(*)::DOUBLE AS n, sum(CAST(event > 0 AS INTEGER))::DOUBLE AS d,
             sum(CAST(event = 1 AS INTEGER))::DOUBLE AS d1, sum(CAST(event = 2 AS INTEGER))::DOUBLE AS d2 FROM labels GROUP BY 1),
r AS (SELECT *, sum(n) OVER (ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM c),
s AS (SELECT *, coalesce(product(1 - d / at_risk) OVER (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)
        AS before FROM r),
k AS (SELECT time, at_risk, d AS d_any, before, unnest([1, 2]) AS event, unnest([d1, d2]) AS d FROM s),
aj AS (SELECT *, sum(before * d / at_risk) OVER (PARTITION BY event ORDER BY time) AS cif FROM k)"""


@query(
    "aj_cif",
    f"WITH {LABELS}, {_AJ} SELECT event, time, at_risk::DOUBLE AS at_risk, d, round(cif, 6) AS cif FROM aj",
)
def aj_cif(t: Tables):
    return survival.aj_cif(t.labels, [1, 2]).withColumn("cif", r6("cif"))


@query(
    "aj_variance",
    f"""WITH {LABELS}, {_AJ}, p AS (
      SELECT a.event, a.time, a.cif,
        sum((a.cif - b.cif) ** 2 * CASE WHEN b.at_risk > b.d_any THEN b.d_any / (b.at_risk * (b.at_risk - b.d_any)) ELSE 0 END) AS t1,
        sum(b.before ** 2 * b.d * (b.at_risk - b.d) / b.at_risk ** 3) AS t2,
        sum((a.cif - b.cif) * b.before * b.d / b.at_risk ** 2) AS t3
      FROM aj a JOIN aj b ON a.event = b.event AND b.time <= a.time GROUP BY 1, 2, 3)
    SELECT event, time, round(cif, 6) AS cif, round(t1 + t2 - 2 * t3, 9) AS variance FROM p""",
)
def aj_variance(t: Tables):
    curve = survival.aj_cif(t.labels, [1, 2], variance=True)
    return curve.select("event", "time", r6("cif").alias("cif"), F.round("variance", 9).alias("variance"))


_TRAIN_KM = _KM.replace("FROM labels", "FROM labels WHERE split = 'train'").replace("event = 1", "event > 0")
_CUTS = f"""{_TRAIN_KM},
curve AS (SELECT time, survival FROM km UNION ALL SELECT 0.0, 1.0 WHERE (SELECT min(time) FROM km) > 0),
low AS (SELECT min(survival) AS s, max(survival) AS h FROM curve),
steps AS (SELECT s + (h - s) * (range / 9.0) AS s FROM low, range(10)),
raw AS (SELECT DISTINCT (SELECT max(time) FROM curve c WHERE c.survival + 1e-12 >= steps.s) AS cut FROM steps),
numbered AS (SELECT CAST(row_number() OVER (ORDER BY cut) - 1 AS INTEGER) AS cut_idx, cut FROM raw),
cuts AS (SELECT cut_idx, CASE WHEN cut_idx = 0 THEN 0.0 ELSE cut END::DOUBLE AS cut FROM numbered),
arr AS (SELECT list(cut ORDER BY cut) AS c FROM cuts)"""


def _cuts(t: Tables):
    return session.held(survival.km_cuts(part_of(t.labels, "train"), 10))


@query("km_cuts", f"WITH {LABELS}, {_CUTS} SELECT cut_idx, round(cut, 6) AS cut FROM cuts")
def km_cuts(t: Tables):
    return _cuts(t).withColumn("cut", r6("cut"))


@query(
    "equidistant_cuts",
    f"""WITH {LABELS} SELECT CAST(range AS INTEGER) AS cut_idx,
      round((SELECT max(duration) FROM labels WHERE split = 'train') * range / 9.0, 6) AS cut FROM range(10)""",
)
def equidistant_cuts(t: Tables):
    return survival.make_cuts(part_of(t.labels, "train"), 10, "equidistant").withColumn("cut", r6("cut"))


@query(
    "discretise_labels",
    f"""WITH {LABELS}, {_CUTS} SELECT stay_id, event, CAST(greatest(0, least(len(c) - 1, CASE WHEN event > 0
        THEN len(list_filter(c, lambda x: x < duration)) ELSE len(list_filter(c, lambda x: x <= duration)) - 1 END)) AS INTEGER)
      AS duration_idx, CASE WHEN duration > list_max(c) THEN 0 ELSE event END AS event_idx FROM labels, arr""",
)
def discretise_labels(t: Tables):
    return survival.discretise_labels(t.labels, _cuts(t)).select("stay_id", "event", "duration_idx", "event_idx")


@query(
    "digitize_durations",
    f"""WITH {LABELS}, {_CUTS} SELECT stay_id, CAST(len(list_filter(c, lambda x: x <= duration)) AS INTEGER) AS bin
    FROM labels, arr""",
)
def digitize_durations(t: Tables):
    return survival.digitize_durations(t.labels, _cuts(t)).select("stay_id", "bin")
