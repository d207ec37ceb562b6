"""Static features, long: ``(stay_id, feature, value)`` plus a vocabulary of (column, level)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortframe import session
from cohortframe.functions import scalars as S
from cohortframe.operators.events import long_from_wide
from cohortframe.operators.running import ranked


def _level_pairs(columns: Sequence[str]) -> Column:
    """Array of (column position, column, level) with empty levels left out."""
    pairs = [
        F.struct(F.lit(i).alias("column_idx"), F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
        for i, c in enumerate(columns)
    ]
    return F.filter(F.array(*pairs), lambda p: p["level"].isNotNull())


def level_vocabulary(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> DataFrame:
    """Distinct levels per column, sorted, as ``(column_idx, column, level, feature, level_rank)``."""
    levels = df.select(F.explode(_level_pairs(columns)).alias("p")).select("p.*").distinct()
    places = ranked(levels, ["level"], ["column_idx", "column"], "level_rank")
    kept = places.where("level_rank > 1") if drop_first else places
    return kept.withColumn("feature", F.concat_ws("_", "column", "level"))


def one_hot(df: DataFrame, columns: Sequence[str], vocabulary: DataFrame | None = None) -> DataFrame:
    """A row of value 1 per stay and level. An empty level gives no row, which means zeros throughout.

    A vocabulary with the first level of each column dropped turns this into the drop-first encoding.
    """
    hot = df.select("stay_id", F.explode(_level_pairs(columns)).alias("p")).select(
        "stay_id", F.concat_ws("_", "p.column", "p.level").alias("feature"), F.lit(1.0).alias("value")
    )
    return hot if vocabulary is None else hot.join(vocabulary.select("feature"), "feature", "left_semi")


def numeric_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long_from_wide(df, ["stay_id"], columns)


def static_vocabulary(
    levels: DataFrame, numeric: Sequence[str], categorical: Sequence[str], trailing: Sequence[str] = ()
) -> DataFrame:
    """``(feature, kind, order_key)`` in column order: numeric columns, levels per column, trailing numerics.

    ``levels`` is ``level_vocabulary`` of the categorical columns. Kinds are ``numeric`` and ``level``.
    """
    hot = levels.select("feature", F.lit("level").alias("kind"), (F.col("column_idx") + 1).alias("block"),
                        F.col("level_rank").alias("position"))
    return numeric_vocabulary(levels.sparkSession, numeric, len(categorical), trailing).unionByName(hot)


def numeric_vocabulary(spark: SparkSession, numeric: Sequence[str], n_categorical: int = 0, trailing: Sequence[str] = ()) -> DataFrame:
    """The numeric columns of ``static_vocabulary``, with ``n_categorical`` blocks left free between the two kinds."""
    fixed = [(c, "numeric", 0, i) for i, c in enumerate(numeric)]
    fixed += [(c, "numeric", 2 + n_categorical, i) for i, c in enumerate(trailing)]
    return session.literal_table(spark, fixed, "feature string, kind string, block int, position int")


def select_static(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Remove id and outcome columns from the static features."""
    return df.drop(*drop)


@dataclass(frozen=True)
class Block:
    """The slots of one static column: a number with the value that replaces a missing one, or a slot per level."""

    column: str
    levels: tuple | None = None
    fill: float | None = None

    @property
    def names(self) -> list[str]:
        return [self.column] if self.levels is None else [f"{self.column}_{level}" for level in self.levels]


def static_blocks(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    trailing: Sequence[str] = (),
    train: DataFrame | None = None,
    levels: DataFrame | None = None,
) -> list[Block]:
    """Numeric columns, levels of each category, trailing numeric columns. Levels come from all of ``df``, or from
    ``levels`` (its ``level_vocabulary``). They are held on the driver: a dense row has a slot for each of them.

    With ``train`` a missing number becomes its train mean (0 without any), otherwise it stays NULL.
    """
    numbers = [*numeric, *trailing]
    fills = dict.fromkeys(numbers)
    if train is not None and numbers:
        means = train.agg(*[F.avg(_number(c)).alias(c) for c in numbers]).first()
        fills = {c: 0.0 if means[c] is None else means[c] for c in numbers}
    by_column: dict[str, list] = {c: [] for c in categorical}
    if categorical:
        vocabulary = (level_vocabulary(df, categorical) if levels is None else levels).select("column", "level", "level_rank")
        for row in sorted(vocabulary.collect(), key=lambda r: r.level_rank):
            by_column[row.column].append(row.level)
    hot = [Block(c, tuple(found)) for c, found in by_column.items() if found]
    return [*[Block(c, fill=fills[c]) for c in numeric], *hot, *[Block(c, fill=fills[c]) for c in trailing]]


def _number(column: str) -> Column:
    return S.nan_to_null(F.col(column).cast("double"))


def _hot_slots(column: str, levels: tuple) -> Column:
    """A 1 at the level's slot, zeros elsewhere; copied array stretches, no test per level in a lambda."""
    at = F.array_position(F.array(*[F.lit(level) for level in levels]), F.col(column).cast("string")).cast("int")
    zero, one = F.lit(0.0).cast("float"), F.lit(1.0).cast("float")
    found = F.concat(F.array_repeat(zero, at - 1), F.array(one), F.array_repeat(zero, F.lit(len(levels)) - at))
    return F.coalesce(F.when(at > 0, found), F.array_repeat(zero, len(levels)))


def with_static_arrays(df: DataFrame, blocks: Sequence[Block]) -> DataFrame:
    """Add ``static`` and ``static_mask`` to rows that hold the static columns; nothing is shuffled.

    A level is always observed, a missing number is not.
    """
    values, seen = [], []
    for block in blocks:
        if block.levels is None:
            number = _number(block.column)
            values.append(F.array(F.coalesce(number, F.lit(block.fill).cast("double")).cast("float")))
            seen.append(F.array(number.isNotNull().cast("float")))
        else:
            values.append(_hot_slots(block.column, block.levels))
            seen.append(F.array_repeat(F.lit(1.0).cast("float"), len(block.levels)))
    empty = F.array().cast("array<float>")
    return df.withColumns(
        {"static": F.concat(*values) if values else empty, "static_mask": F.concat(*seen) if seen else empty}
    )
