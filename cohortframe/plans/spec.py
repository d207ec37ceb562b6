"""A data set as a specification: functions from raw tables to canonical frames, and one driver for all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortframe.operators import reports as R
from cohortframe.operators.cohort import require_columns
from cohortframe.operators.losses import Losses
from cohortframe.params import Preparation
from cohortframe.plans import common

Inputs = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Codes:
    """``vocabulary`` (``code, n, code_idx, feature``) with either the stays' ``cells`` (``stay_id, pos, value``) or
    ``subject_counts`` (``subject_id, code, n``)."""

    vocabulary: DataFrame
    cells: DataFrame | None = None
    subject_counts: DataFrame | None = None


@dataclass(frozen=True)
class DataSet:
    """How the raw tables of one source become canonical frames. Each function gets the tables that are there, by name.

    * ``stays``: one row per stay, ``stay_id, subject_id, duration, event`` and the static columns.
    * ``cells``: hourly ``stay_id, split, hour, feature, value[, block]`` of the cohort, if any table of ``series`` is there.
    * ``codes``: vocabulary and codes, if the table ``coded`` is there.
    * ``texts``: ``stay_id, text`` of the cohort, if the table ``reported`` is there.

    The functions count what they leave out in the ``Losses`` they are given. ``required`` names columns by table; a table
    that is there and lacks one is an error that names it.
    """

    stays: Callable[[Inputs, Preparation, Losses], DataFrame]
    static: common.Static | None = None
    cells: Callable[[Inputs, DataFrame, Preparation, Losses], DataFrame] | None = None
    series: Sequence[str] = ()
    codes: Callable[[Inputs, DataFrame, Preparation], Codes] | None = None
    coded: str | None = None
    texts: Callable[[Inputs, DataFrame, Preparation, Losses], DataFrame] | None = None
    reported: str | None = None
    required: Mapping[str, Sequence[str]] = ()


STAY_COLUMNS = ("stay_id", "subject_id", "duration", "event")


def prepare(
    data_set: DataSet, inputs: Mapping[str, DataFrame | None], params: Preparation, static: bool = True,
    encoder: R.Encoder | None = None, encoder_dim: int | None = None,
) -> dict[str, DataFrame]:
    """Run a data set: stays, split, series, codes and reports as far as their tables are there, fitting and assembly."""
    given = {name: df for name, df in inputs.items() if df is not None}
    for name, columns in dict(data_set.required).items():
        if name in given:
            require_columns(given[name], columns, name)
    losses = Losses()
    stays = require_columns(data_set.stays(given, params, losses), STAY_COLUMNS, "stays")
    cohort = common.split_cohort(stays, params)
    cells = codes = vectors = dim = weights = None
    if data_set.cells and any(name in given for name in data_set.series):
        cells = data_set.cells(given, cohort, params, losses)
    if data_set.codes and data_set.coded in given:
        codes = data_set.codes(given, cohort, params)
    if data_set.texts and data_set.reported in given:
        texts = data_set.texts(given, cohort, params, losses)
        vectors, dim, weights = common.report_vectors(texts, params, encoder, encoder_dim, common.train_of(cohort))
    coded = codes or Codes(None)
    out = common.outputs(
        cohort, params, cells, data_set.static if static else None, coded.cells, coded.vocabulary, vectors, dim, coded.subject_counts, losses
    )
    return out if weights is None else out | {"slot_weights": weights}
