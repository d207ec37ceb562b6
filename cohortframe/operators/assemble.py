"""From long cells to one tensor row per stay."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.operators.running import ranked


@dataclass(frozen=True)
class Layout:
    """Feature order of the tensor and the value of a missing dynamic cell.

    Held on the driver: a tensor row has a slot for each feature in every window, so the names of one row fit there.
    """

    dynamic: list
    dynamic_fill: list
    static: list

    @property
    def n_dynamic(self) -> int:
        return len(self.dynamic)

    @property
    def n_static(self) -> int:
        return len(self.static)


def feature_structure(dynamic: DataFrame, static: DataFrame) -> DataFrame:
    """``(feature, kind, idx)`` from two vocabularies with ``feature`` and the ordering columns ``block, position``:
    dynamic features first, static after them.
    """
    both = dynamic.select("feature", F.lit("dynamic").alias("kind"), F.lit(0).alias("_k"), "block", "position")
    both = both.unionByName(
        static.select("feature", F.lit("static").alias("kind"), F.lit(1).alias("_k"), "block", "position")
    )
    placed = ranked(both, ["_k", "block", "position", "feature"], name="idx")
    return placed.select("feature", "kind", (F.col("idx") - 1).cast("int").alias("idx"))


def make_layout(dynamic: DataFrame, params: DataFrame | None = None, static: Sequence[str] = ()) -> Layout:
    """Collect the dynamic vocabulary ``(feature, block, position)`` with its fill values.

    ``params`` is the scaler: a missing dynamic cell becomes a scaled zero. ``static`` names the static slots.
    """
    named = dynamic.select("feature", "block", "position")
    if params is not None:
        named = named.join(params, "feature", "left")
    else:
        named = named.withColumns({"mean": F.lit(0.0), "scale": F.lit(1.0)})
    fill = F.coalesce((F.lit(0.0) - F.col("mean")) / F.col("scale"), F.lit(0.0))
    ordered = named.withColumn("fill", fill).orderBy("block", "position", "feature")
    rows = ordered.collect()
    return Layout([r["feature"] for r in rows], [r["fill"] for r in rows], list(static))


def _positions(spark: SparkSession, names: list) -> DataFrame:
    """Slots by name; a long list is written and joined by shuffle."""
    table = session.literal_table(spark, [(name, i) for i, name in enumerate(names)], "feature string, _idx int")
    return F.broadcast(table) if len(names) <= session.SMALL_ROWS else session.barrier(table, "positions")


def _packed(cells: DataFrame, pos: Column, name: str) -> DataFrame:
    """Cells of a stay as one sorted array: at most windows x features entries, whatever the raw event count."""
    placed = cells.where(F.col("value").isNotNull()).select("stay_id", pos.cast("int").alias("pos"), "value")
    return placed.groupBy("stay_id").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias(name))


def tensor_rows(cohort: DataFrame, cells: DataFrame, layout: Layout, num_windows: int) -> DataFrame:
    """Add ``x`` and ``mask`` (``[window][feature]``) to every cohort stay.

    ``cells`` are the (scaled) window means ``(stay_id, window, feature, value)``. Only observed cells are shuffled; the
    dense form appears inside the task that writes the row. Columns ``static`` and ``static_mask`` of the cohort, if
    there, are appended to every window and dropped.
    """
    nd = layout.n_dynamic
    placed = cells.join(_positions(cohort.sparkSession, layout.dynamic), "feature")
    packed = _packed(placed, F.col("window") * F.lit(nd) + F.col("_idx"), "_cells")
    out = cohort.join(packed, "stay_id", "left")
    parts = [c for c in ("static", "static_mask") if c in cohort.columns]
    kept = [f for f in cohort.schema if f.name not in parts]
    grid = ArrayType(ArrayType(FloatType()))
    schema = StructType([*kept, StructField("x", grid), StructField("mask", grid)])
    dense = _Dense(np.array(layout.dynamic_fill, np.float32), num_windows, len(kept), len(parts))
    return out.select(*[f.name for f in kept], "_cells", *parts).mapInArrow(dense.run, schema)


@dataclass
class _Dense:
    """Scatters the cells of a batch into dense values and mask: one assignment each, static slots appended."""

    fill: np.ndarray
    num_windows: int
    n_kept: int
    n_parts: int
    most_floats: int = 8_000_000

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = len(self.fill)
            if self.n_parts and batch.num_rows:
                width += len(batch.column(self.n_kept + 1)[0])
            step = max(1, self.most_floats // max(1, width * self.num_windows))
            for at in range(0, batch.num_rows, step):
                yield self._rows(batch.slice(at, step))

    def _rows(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, windows, nd = batch.num_rows, self.num_windows, len(self.fill)
        cells = batch.column(self.n_kept)
        flat = cells.flatten()
        row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(cells), 0).to_numpy(zero_copy_only=False))
        pos = pc.struct_field(flat, "pos").to_numpy(zero_copy_only=False)
        x = np.tile(self.fill, (n, windows))
        mask = np.zeros((n, windows * nd), np.float32)
        x[row, pos] = pc.struct_field(flat, "value").to_numpy(zero_copy_only=False)
        mask[row, pos] = 1
        done = []
        for i, part in enumerate((x, mask)):
            part = part.reshape(n, windows, nd)
            if self.n_parts:
                static = batch.column(self.n_kept + 1 + i).flatten().to_numpy(zero_copy_only=False).reshape(n, 1, -1)
                part = np.concatenate([part, np.broadcast_to(static, (n, windows, static.shape[2]))], axis=2)
            inner = pa.ListArray.from_arrays(
                pa.array(np.arange(n * windows + 1, dtype=np.int32) * part.shape[2]), pa.array(part.ravel(), pa.float32())
            )
            done.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * windows), inner))
        names = [*batch.schema.names[: self.n_kept], "x", "mask"]
        return pa.RecordBatch.from_arrays([*batch.columns[: self.n_kept], *done], names=names)


# --- sparse rows ------------------------------------------------------------------------------------------------------


def sparse_vocabulary(
    structure: DataFrame, dynamic_params: DataFrame | None = None, static_means: DataFrame | None = None
) -> DataFrame:
    """``(feature, kind, idx, fill)``: the place of each feature and the value of a cell that no row lists.

    A missing dynamic cell is a scaled zero (``dynamic_params``: the scaler), a missing static number its train mean
    (``static_means``; 0 without one), a level that is not listed is 0.
    """
    out = structure
    fill = F.lit(0.0)
    if dynamic_params is not None:
        out = out.join(dynamic_params.select(F.col("feature").alias("_f"), "mean", "scale"), F.col("feature") == F.col("_f"), "left").drop("_f")
        fill = F.when(F.col("kind") == "dynamic", (F.lit(0.0) - F.col("mean")) / F.col("scale"))
        out = out.withColumn("fill", F.coalesce(fill, F.lit(0.0))).drop("mean", "scale")
    else:
        out = out.withColumn("fill", fill)
    if static_means is not None:
        means = static_means.select(F.col("feature").alias("_f"), F.col("mean").alias("_mean"))
        out = out.join(means, F.col("feature") == F.col("_f"), "left")
        out = out.withColumn("fill", F.when(F.col("kind") == "static", F.coalesce("_mean", "fill")).otherwise(F.col("fill"))).drop("_f", "_mean")
    return out.select("feature", "kind", "idx", F.col("fill").cast("float").alias("fill"))


def sparse_rows(cohort: DataFrame, vocabulary: DataFrame, cells: DataFrame | None, static_cells: DataFrame | None = None) -> DataFrame:
    """Add ``steps`` (``[(window, indices, values)]`` by window) and ``static`` (``(indices, values)``) to every cohort stay.

    ``cells`` are the (scaled) window means ``(stay_id, window, feature, value)``, ``static_cells`` are ``(stay_id, feature,
    value)``. Only observed cells appear, in rising index. The vocabulary is a table: it is joined, never collected, so a
    row costs what was observed and the number of features has no bound. Pass it through ``session.small``.
    """
    entry = F.sort_array(F.collect_list(F.struct("idx", F.col("value").cast("float").alias("value"))))

    def listed(part: DataFrame, kind: str, keys: list[str]) -> DataFrame:
        places = vocabulary.where(F.col("kind") == kind).select("feature", "idx")
        placed = part.where(F.col("value").isNotNull()).join(places, "feature")
        return placed.groupBy(*keys).agg(entry.alias("_e")).withColumns({"indices": F.col("_e.idx"), "values": F.col("_e.value")}).drop("_e")

    out = cohort
    if cells is not None:
        steps = listed(cells, "dynamic", ["stay_id", "window"])
        # At most one entry a window.
        steps = steps.groupBy("stay_id").agg(F.sort_array(F.collect_list(F.struct("window", "indices", "values"))).alias("steps"))
        out = out.join(steps, "stay_id", "left")
        out = out.withColumn("steps", F.coalesce("steps", F.array().cast(steps.schema["steps"].dataType)))
    if static_cells is not None:
        static = listed(static_cells, "static", ["stay_id"]).select("stay_id", F.struct("indices", "values").alias("static"))
        out = out.join(static, "stay_id", "left")
        nothing = F.struct(F.array().cast("array<int>").alias("indices"), F.array().cast("array<float>").alias("values"))
        out = out.withColumn("static", F.coalesce("static", nothing))
    return out


def densify(rows: DataFrame, vocabulary: DataFrame, num_windows: int, levels: DataFrame | None = None) -> DataFrame:
    """``x`` and ``mask`` from ``steps`` and ``static`` of sparse rows: the dense rows of the same data set.

    ``levels`` names the features (column ``feature``) that are always observed. The fill values become one row as wide as
    a dense row, so this is for vocabularies of which a dense row can be held.
    """
    always = F.lit(0.0)
    places = vocabulary
    if levels is not None:
        known = levels.select(F.col("feature").alias("_f")).distinct()
        places = places.join(known, F.col("feature") == F.col("_f"), "left")
        always = F.when(F.col("_f").isNotNull(), 1.0).otherwise(0.0)
    base = places.agg(F.sort_array(F.collect_list(F.struct("idx", "fill", always.cast("float").alias("seen")))).alias("b"))
    wide = rows.withColumn("_b", base.scalar())
    wide = wide.withColumns({"_fill": F.col("_b.fill"), "_seen": F.col("_b.seen")}).drop("_b")

    def filled(base_array: str, value) -> Column:
        def window(w: Column) -> Column:
            step = F.get(F.filter("steps", lambda s: s["window"] == w), F.lit(0)) if "steps" in rows.columns else None
            pairs = [] if step is None else [F.coalesce(F.arrays_zip(step["indices"].alias("pos"), step["values"].alias("value")), no_pairs)]
            if "static" in rows.columns:
                pairs.append(F.arrays_zip(F.col("static.indices").alias("pos"), F.col("static.values").alias("value")))
            named = [F.transform(p, lambda z: F.struct(z["pos"].alias("pos"), z["value"].alias("value"))) for p in pairs]
            return S.overlay(F.col(base_array), F.concat(*named), value)

        no_pairs = F.array().cast("array<struct<pos:int,value:float>>")
        return F.transform(F.sequence(F.lit(0), F.lit(num_windows - 1)), window)

    dense = wide.withColumns({"x": filled("_fill", lambda c: c["value"]), "mask": filled("_seen", lambda c: F.lit(1.0).cast("float"))})
    return dense.drop("_fill", "_seen", "steps", "static")


def flatten_tensor(rows: DataFrame) -> DataFrame:
    """``(stay_id, window, idx, value, mask)`` from tensor rows, unrolled in place."""
    steps = rows.select("stay_id", "mask", F.posexplode("x").alias("window", "_x"))
    cells = steps.select(
        "stay_id", "window", F.get("mask", F.col("window")).alias("_m"), F.posexplode("_x").alias("idx", "value")
    )
    return cells.select("stay_id", "window", "idx", "value", F.get("_m", F.col("idx")).alias("mask"))


def dense_grid(stays: DataFrame, cells: DataFrame, features: list, steps: int, step: str = "window") -> DataFrame:
    """Every stay x step x feature with the measured value or NULL.

    Observed cells meet their stay once; the grid is then unrolled in place instead of being joined row by row.
    """
    spark = stays.sparkSession
    n = len(features)
    placed = cells.join(_positions(spark, features), "feature")
    packed = _packed(placed, F.col(step) * F.lit(n) + F.col("_idx"), "_cells")
    grid = stays.select("stay_id").join(packed, "stay_id", "left")
    grid = grid.select("stay_id", F.posexplode(S.scatter("_cells", n * steps)).alias("_pos", "value"))
    names = F.array(*[F.lit(f) for f in features])
    return grid.select(
        "stay_id",
        F.floor(F.col("_pos") / F.lit(n)).cast("int").alias(step),
        F.get(names, F.col("_pos") % F.lit(n)).alias("feature"),
        "value",
    )
