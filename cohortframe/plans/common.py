"""Steps shared by the data-set plans: split cohort -> fitted vocabularies -> tensor rows."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortframe import session
from cohortframe.operators import assemble, codes, events, reports, select, split, static as static_ops, survival, transform
from cohortframe.operators.losses import Losses
from cohortframe.params import Preparation

KEYS = ["stay_id", "subject_id", "split", "duration", "event"]


def split_cohort(stays: DataFrame, params: Preparation) -> DataFrame:
    """Horizon-censored labels with their split, written once because every later pass needs them."""
    labelled = survival.censor_at(stays, params.labels.horizon_hours)
    return session.barrier(split.assign_split(labelled, params.split), "cohort")


def train_of(cohort: DataFrame) -> DataFrame:
    return split.part_of(cohort, "train")


def dynamic_vocabulary(cells: DataFrame, cohort: DataFrame, params: Preparation) -> DataFrame:
    """Features observed often enough in train, with their place: ``(feature, block, position)``."""
    block = F.min("block") if "block" in cells.columns else F.min(F.lit(0))
    rates = select.presence(
        cells, train_of(cohort), params.windows.max_hours, params.presence_denominator, [block.alias("block")]
    )
    kept = select.dense_enough(rates, params.presence_threshold).withColumn("position", F.lit(0))
    return session.small(kept, name="dynamic_vocab")


def report_vectors(
    texts: DataFrame, params: Preparation, encoder: reports.Encoder | None = None, dim: int | None = None, train: DataFrame | None = None
) -> tuple[DataFrame, int, DataFrame | None]:
    """Pooled vector per stay with reports, from a user's encoder (with its dimension) or the native hashed one.

    The third value is the table of slot weights, fitted on ``train``, where they are asked for.
    """
    if encoder is not None:
        return reports.pool_vectors(reports.encode_reports(texts, encoder, params.reports.batch_size)), dim, None
    dim = params.reports.dim
    if not params.reports.idf:
        return reports.hashed_vectors(texts, dim), dim, None
    sums = session.barrier(reports.slot_sums(texts, dim), "slots")
    weights = session.held(reports.idf_weights(sums, train, dim))
    return reports.weighted_vectors(sums, weights, dim), dim, weights


@dataclass(frozen=True)
class Static:
    """Static columns of the cohort in feature order."""

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    trailing: Sequence[str] = ()


def outputs(
    cohort: DataFrame,
    params: Preparation,
    cells: DataFrame | None = None,
    static: Static | None = None,
    code_cells: DataFrame | None = None,
    code_vocab: DataFrame | None = None,
    vectors: DataFrame | None = None,
    vector_dim: int | None = None,
    subject_counts: DataFrame | None = None,
    losses: Losses | None = None,
) -> dict[str, DataFrame]:
    """Fit on train, impute, scale and assemble. ``cells`` are hourly
    ``(stay_id, split, hour, feature, value[, block])``; ``static`` names columns of the cohort. Codes come per stay
    (``code_cells``) or per patient (``subject_counts``).

    Fitted tables are evaluated once; the rows themselves stay lazy until they are written. ``losses`` counts what the
    steps before left out, by input and reason; its numbers come with the hand-over tables written until here.
    """
    spark = cohort.sparkSession
    w = params.windows
    if params.dynamic_imputation != "zero":
        warnings.warn(f"dynamic imputation {params.dynamic_imputation!r} is not available; using zero", stacklevel=2)
    train = train_of(cohort)
    any_event = train.withColumn("event", survival.any_event())
    cuts = session.held(survival.make_cuts(any_event, params.labels.n_time_bins, params.labels.scheme))
    out: dict[str, DataFrame] = {"cuts": cuts}

    if params.layout not in ("dense", "sparse"):
        raise ValueError(f"unknown layout {params.layout!r}")
    sparse = params.layout == "sparse"
    rows, names, means, static_cells = cohort.select(*KEYS), [], None, None
    static_vocab = session.literal_table(spark, [], "feature string, kind string, block int, position int")
    if static is not None:
        levels = None
        if static.categorical:
            levels = static_ops.level_vocabulary(cohort, static.categorical)
            static_vocab = static_ops.static_vocabulary(levels, static.numeric, static.categorical, static.trailing)
        else:
            static_vocab = static_ops.numeric_vocabulary(spark, static.numeric, 0, static.trailing)
        if sparse:
            numbers = static_ops.numeric_features(cohort, [*static.numeric, *static.trailing])
            means = transform.static_means(numbers, train) if params.static_imputation == "mean" else None
            static_cells = numbers.unionByName(static_ops.one_hot(cohort, static.categorical)) if static.categorical else numbers
        else:
            fit = train if params.static_imputation == "mean" else None
            parts = static_ops.static_blocks(cohort, static.numeric, static.categorical, static.trailing, fit, levels)
            names = [name for part in parts for name in part.names]
            rows = static_ops.with_static_arrays(cohort, parts).select(*KEYS, "static", "static_mask")
    scaler = None
    if cells is not None:
        cells = session.barrier(cells, "cells")
        vocab = dynamic_vocabulary(cells, cohort, params)
        kept = select.keep_features(cells, vocab.select("feature"))
        windows = events.window_mean(kept, w.window_hours, w.num_windows, ["stay_id", "split"])
        windows = session.barrier(windows, "windows")
        if params.scaling != "none":
            fitted = transform.scaler_params(windows, train, w.num_windows, params.fit_on_observed)
            scaler = session.small(fitted, name="scaler")
            out["scaler_params"] = scaler
    else:
        vocab = session.literal_table(spark, [], "feature string, block int, position int")
    structure = assemble.feature_structure(vocab, static_vocab)
    scaled = None
    if cells is not None:
        scaled = transform.scaled(windows, scaler) if scaler is not None else windows
    if sparse:
        places = session.small(assemble.sparse_vocabulary(structure, scaler, means), name="feature_vocab")
        out["feature_vocab"] = places
        rows = assemble.sparse_rows(rows, places, scaled, static_cells)
        counts = {r["kind"]: r["count"] for r in places.groupBy("kind").count().collect()}
        width = counts.get("dynamic", 0), counts.get("static", 0)
    else:
        out["feature_vocab"] = structure
        layout = assemble.make_layout(vocab, scaler, names)
        if scaled is not None:
            rows = assemble.tensor_rows(rows, scaled, layout, w.num_windows)
        width = layout.n_dynamic, layout.n_static
    n_codes = None
    if code_vocab is not None:
        n_codes = code_vocab.count()
        if subject_counts is None:
            rows = codes.vector_per_stay(rows, code_cells, n_codes, "icd")
        else:
            rows = codes.vector_per_subject(rows, subject_counts, code_vocab, n_codes, "icd", params.codes.value)
        out["code_vocab"] = code_vocab
    if vectors is not None:
        vectors = session.barrier(vectors, "vectors")
        rows = reports.with_vectors(rows, vectors, vector_dim, "radiology")
    out["rows"] = rows

    modalities = [
        name
        for name, part in
        [("timeseries", cells), ("static", static), ("icd", code_vocab), ("radiology", vectors)]
        if part is not None
    ]
    out["run_info"] = session.literal_table(
        spark,
        [
            (
                modalities, params.labels.competing, params.labels.n_events, params.labels.n_time_bins, cuts.count(),
                w.num_windows, *width, n_codes, vector_dim,
            )
        ],
        "active_modalities array<string>, competing_risks boolean, n_events int, n_time_bins int, n_cuts bigint, "
        "n_windows int, n_dynamic int, n_static int, n_codes int, vector_dim int",
    )
    if losses is not None:
        out["losses"] = losses.table(spark)
    return out
