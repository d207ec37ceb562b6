"""What the operators share: word and line expressions, row keys, the query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortframe import session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The six white-space characters that part words; everything else belongs to a word.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
#: Words of a five-word shingle and the least similarity of near-duplicates.
SHINGLE, SIMILAR = 5, 75


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with the SQL that gives the same rows where there is one."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session.tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | Column) -> Column:
    """The words of a text; none for null and for texts of white space."""
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def text_mark(text: str | Column) -> Column:
    """Tells rows with the same id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def rows_per_group(rows: int, per_group: int) -> int:
    """How many groups of about ``per_group`` rows hold ``rows`` rows; at least one."""
    return max(1, -(-rows // per_group))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened where a column is already called so (in any case)."""
    have, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out
