"""Queries over imputation, scaling and tensor assembly."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from cohortframe import session
from cohortframe.catalog.base import FEATURES, MAX_HOURS, NUM_WINDOWS, ST, TS, WINDOW_HOURS, Tables, query, r6
from cohortframe.catalog.statics import _LEVELS, CATEGORIES
from cohortframe.operators import assemble, events as E, static as static_ops, transform
from cohortframe.operators.split import part_of
from cohortframe.params import Labels, Preparation, Windows
from cohortframe.plans import common
from cohortframe.sources import tables

_SCALER = """
scaler AS (SELECT feature, avg(coalesce(value, 0.0)) AS mean, stddev_pop(coalesce(value, 0.0)) AS sd
           FROM grid WHERE split = 'train' GROUP BY feature)"""


@query(
    "impute_zero",
    f'WITH {TS} SELECT stay_id, win AS "window", feature, round(coalesce(value, 0.0), 6) AS value FROM grid',
)
def impute_zero(t: Tables):
    grid = assemble.dense_grid(t.users, t.windows, FEATURES, NUM_WINDOWS)
    return grid.withColumn("value", r6(F.coalesce("value", F.lit(0.0))))


@query(
    "scaler_params",
    f"""WITH {TS}, {_SCALER} SELECT feature, round(mean, 6) AS mean, round(CASE WHEN sd > 1e-12 THEN sd ELSE 1 END, 6) AS scale
    FROM scaler""",
)
def scaler_params(t: Tables):
    params = transform.scaler_params(t.split_windows, part_of(t.users, "train"), NUM_WINDOWS)
    return params.withColumns({"mean": r6("mean"), "scale": r6("scale")})


@query(
    "scaler_params_observed",
    f"""WITH {TS} SELECT feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS scale
    FROM grid WHERE split = 'train' AND value IS NOT NULL GROUP BY feature""",
)
def scaler_params_observed(t: Tables):
    params = transform.scaler_params(t.split_windows, part_of(t.users, "train"), NUM_WINDOWS, fit_on_observed=True)
    return params.withColumns({"mean": r6("mean"), "scale": r6("scale")})


@query(
    "scaled_values",
    f"""WITH {TS}, {_SCALER} SELECT stay_id, win AS "window", g.feature, round((value - mean) / sd, 6) AS value
    FROM grid g JOIN scaler s ON g.feature = s.feature WHERE value IS NOT NULL""",
)
def scaled_values(t: Tables):
    windows = session.barrier(t.split_windows, "windows")
    params = session.small(transform.scaler_params(windows, part_of(t.users, "train"), NUM_WINDOWS))
    return transform.scaled(windows, params).select("stay_id", "window", "feature", r6("value").alias("value"))


@query(
    "scaled_unseen_feature",
    f"""WITH {TS}, t AS (SELECT w.*, split FROM windows w JOIN users USING (stay_id) WHERE NOT (split = 'train' AND feature = 'view')),
    n AS (SELECT count(*) * {NUM_WINDOWS} AS n FROM users WHERE split = 'train'),
    s AS (SELECT feature, sum(value) / max(n) AS mean, sqrt(sum(value * value) / max(n) - (sum(value) / max(n)) ** 2) AS sd
      FROM t, n WHERE split = 'train' GROUP BY 1)
    SELECT stay_id, win AS "window", t.feature, round(CAST((value - coalesce(mean, 0)) / coalesce(sd, 1) AS FLOAT)::DOUBLE, 3) AS value,
      CAST(1 AS INTEGER) AS mask FROM t LEFT JOIN s ON s.feature = t.feature""",
)
def scaled_unseen_feature(t: Tables):
    """Cells and mask where one feature never occurs in train: none of its cells is lost, and they stay unscaled."""
    unseen = (F.col("split") == "train") & (F.col("feature") == "view")
    windows = session.barrier(t.split_windows.where(~unseen), "windows")
    params = session.small(transform.scaler_params(windows, part_of(t.users, "train"), NUM_WINDOWS))
    vocabulary = windows.select("feature").distinct().selectExpr("feature", "0 as block", "0 as position")
    layout = assemble.make_layout(vocabulary, params)
    rows = assemble.tensor_rows(t.users.select("stay_id"), transform.scaled(windows, params), layout, NUM_WINDOWS)
    names = F.array(*[F.lit(f) for f in layout.dynamic])
    return assemble.flatten_tensor(rows).where("mask = 1").select(
        "stay_id", "window", F.get(names, F.col("idx")).alias("feature"),
        F.round(F.col("value").cast("double"), 3).alias("value"), F.col("mask").cast("int").alias("mask"),
    )


PARAMS = Preparation(windows=Windows(NUM_WINDOWS, WINDOW_HOURS), labels=Labels(horizon_hours=600.0))


def prepared(t: Tables, params: Preparation = PARAMS) -> dict:
    """Users as stays: hours from first to last event, an error among them as the event, their events as series and
    the customer of the same number as static features."""
    per_user = t.measurements.groupBy("stay_id").agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.max((F.col("value") > 40).cast("int")).alias("event")
    )
    duration = (F.unix_micros(F.col("t1").cast("timestamp")) - F.unix_micros(F.col("t0").cast("timestamp"))) / F.lit(3.6e9)
    stays = per_user.select("stay_id", F.col("stay_id").alias("subject_id"), duration.alias("duration"), "event")
    described = stays.join(t.customers.drop("subject_id", "split"), "stay_id", "left")
    cohort = common.split_cohort(described, params)
    static = common.Static(["balance"], CATEGORIES)
    return common.outputs(cohort, params, E.with_split(t.hourly, cohort), static)


@query("tensor_rows")
def tensor_rows(t: Tables):
    return prepared(t)["rows"]


_FLAT = f"""{TS}, {_SCALER}, {ST}, {_LEVELS},
uv AS (SELECT v.* FROM vocab v WHERE v.feature IN (SELECT feature FROM hot WHERE stay_id IN (SELECT stay_id FROM users))),
order_ AS (SELECT feature, 0 AS a, 0 AS b, 0 AS k FROM features UNION ALL SELECT 'balance', 1, 0, 0
           UNION ALL SELECT feature, 1, ci, k FROM uv),
idx AS (SELECT feature, a, CAST(row_number() OVER (ORDER BY a, b, k, feature) - 1 AS INTEGER) AS idx FROM order_),
bal AS (SELECT avg(balance) AS mean FROM customers c JOIN users u ON c.stay_id = u.stay_id WHERE u.split = 'train'),
flat AS (
  SELECT g.stay_id, g.win, i.idx, (coalesce(value, 0.0) - mean) / sd AS value, CASE WHEN value IS NULL THEN 0 ELSE 1 END AS mask
  FROM grid g JOIN scaler s ON g.feature = s.feature JOIN idx i ON i.feature = g.feature AND i.a = 0
  UNION ALL
  SELECT u.stay_id, CAST(w.range AS INTEGER), i.idx,
    CASE WHEN i.feature = 'balance' THEN coalesce(balance, (SELECT mean FROM bal)) WHEN h.feature IS NULL THEN 0.0 ELSE 1.0 END,
    CASE WHEN i.feature = 'balance' AND balance IS NULL THEN 0 ELSE 1 END
  FROM users u CROSS JOIN range({NUM_WINDOWS}) w JOIN idx i ON i.a = 1 LEFT JOIN customers c ON c.stay_id = u.stay_id
  LEFT JOIN hot h ON h.stay_id = u.stay_id AND h.feature = i.feature)"""
_FLAT_SQL = f"""WITH {_FLAT} SELECT stay_id, win AS "window", idx, round(CAST(value AS FLOAT)::DOUBLE, 4) AS value,
  CAST(mask AS INTEGER) AS mask FROM flat"""


def _flat(rows):
    cells = assemble.flatten_tensor(rows)
    return cells.withColumns({"value": F.round(F.col("value").cast("double"), 4), "mask": F.col("mask").cast("int")})


@query("tensor_flat", _FLAT_SQL)
def tensor_flat(t: Tables):
    return _flat(prepared(t)["rows"])


_SPARSE = dataclasses.replace(PARAMS, layout="sparse")


@query("sparse_tensor_flat", _FLAT_SQL)
def sparse_tensor_flat(t: Tables):
    """The data set in sparse rows, made dense: the same cells as the dense one."""
    out = prepared(t, _SPARSE)
    levels = static_ops.level_vocabulary(t.customers, CATEGORIES)
    return _flat(assemble.densify(out["rows"], out["feature_vocab"], NUM_WINDOWS, levels))


@query(
    "sparse_rows",
    f"""WITH {_FLAT} SELECT f.stay_id, f.win AS "window", f.idx, round(CAST(value AS FLOAT)::DOUBLE, 4) AS value FROM flat f
      JOIN idx i ON i.idx = f.idx WHERE mask = 1 AND (i.a = 0 OR (f.win = 0 AND (i.feature = 'balance' OR value = 1)))""",
)
def sparse_rows(t: Tables):
    """The listed cells of the sparse rows; static ones, which a row lists once, as of window 0."""
    rows = prepared(t, _SPARSE)["rows"]
    steps = rows.select("stay_id", F.explode("steps").alias("s"))
    steps = steps.select("stay_id", "s.window", F.explode(F.arrays_zip("s.indices", "s.values")).alias("c"))
    fixed = rows.select("stay_id", F.lit(0).alias("window"), F.explode(F.arrays_zip("static.indices", "static.values")).alias("c"))
    cells = steps.unionByName(fixed)
    return cells.select("stay_id", "window", F.col("c.indices").alias("idx"), F.round(F.col("c.values").cast("double"), 4).alias("value"))


@query("dataset_roundtrip", _FLAT_SQL)
def dataset_roundtrip(t: Tables):
    """The whole prepared data set written, read back and unrolled."""
    path = session.fresh_path(t.spark, "dataset")
    tables.write_dataset(prepared(t), path)
    return _flat(tables.read_dataset(t.spark, path, ["rows"])["rows"])


_EVEN = dataclasses.replace(PARAMS, labels=Labels(horizon_hours=600.0, n_time_bins=7, scheme="equidistant"))


@query(
    "dataset_small_tables",
    f"""WITH {TS}, {_SCALER}, ends AS (
      SELECT user_id, least((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9, 600.0) AS duration FROM events GROUP BY 1),
    longest AS (SELECT max(duration) AS m FROM ends JOIN users ON stay_id = user_id WHERE split = 'train')
    SELECT 'cuts' AS "table", CAST(range AS VARCHAR) AS "key", round((SELECT m FROM longest) * range / 6.0, 6) AS value FROM range(7)
    UNION ALL SELECT 'mean', feature, round(mean, 6) FROM scaler UNION ALL SELECT 'scale', feature, round(CASE WHEN sd > 1e-12 THEN sd ELSE 1 END, 6) FROM scaler
    UNION ALL SELECT 'run_info', 'n_time_bins', 7.0::DOUBLE UNION ALL SELECT 'run_info', 'n_cuts', 7.0::DOUBLE
    UNION ALL SELECT 'run_info', 'n_windows', {NUM_WINDOWS}.0::DOUBLE UNION ALL SELECT 'run_info', 'n_events', 1.0::DOUBLE
    UNION ALL SELECT 'run_info', 'n_dynamic', count(*)::DOUBLE FROM features""",
)
def dataset_small_tables(t: Tables):
    """Cuts, scaler and run information of a written data set, as they are read back."""
    path = session.fresh_path(t.spark, "dataset")
    tables.write_dataset(prepared(t, _EVEN), path)
    back = tables.read_dataset(t.spark, path, ["cuts", "scaler_params", "run_info"])
    cuts = back["cuts"].select(F.lit("cuts").alias("table"), F.col("cut_idx").cast("string").alias("key"), r6("cut").alias("value"))
    scaler = back["scaler_params"].select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("table"), F.col("feature").alias("key"), r6(n).alias("value")) for n in ("mean", "scale")]))
    )
    names = ["n_time_bins", "n_cuts", "n_windows", "n_events", "n_dynamic"]
    info = back["run_info"].select(
        F.inline(F.array(*[F.struct(F.lit("run_info").alias("table"), F.lit(n).alias("key"), F.col(n).cast("double").alias("value")) for n in names]))
    )
    return cuts.unionByName(scaler).unionByName(info)
