"""What a plan leaves out: rows by input and reason, counted while the rows pass through, without a scan of their own.

The counts ride on the job that writes the plan's next hand-over table (``DataFrame.observe``). A task that Spark repeats
after a lost executor may be counted twice, so after such a loss the numbers are upper bounds; the data are not touched.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cohortframe import session

SCHEMA = "input string, step int, reason string, rows bigint"
READ, KEPT = "read", "kept"


@dataclass(frozen=True)
class _Count:
    """One observation of an input: the rows that arrive, then the rows lost for each of ``reasons``.

    With ``since`` the loss is what is missing since the count before: the reason of a join or an aggregate.
    """

    input: str
    observed: Observation
    reasons: tuple = ()
    since: str | None = None


@dataclass
class Losses:
    """Collects the counts of one run of a plan. The table is complete once the plan's hand-over tables are written."""

    _counts: list = field(default_factory=list)

    def keep(self, df: DataFrame, name: str, reasons: Mapping[str, Column]) -> DataFrame:
        """Rows for which no reason holds. A lost row counts for the first reason that does; unknown counts as not so."""
        code = reduce(lambda case, r: case.when(r[1], F.lit(r[0])), enumerate(reasons.values()), F)
        marked = df.withColumn("_loss", code)
        seen = [F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("_loss") == i).alias(f"r{i}") for i in range(len(reasons))]]
        observed = Observation()
        self._counts.append(_Count(name, observed, tuple(reasons)))
        return marked.observe(observed, *seen).where(F.col("_loss").isNull()).drop("_loss")

    def passed(self, df: DataFrame, name: str, reason: str | None = None) -> DataFrame:
        """Counts the rows here. What is missing since the last count of this input was lost for ``reason``."""
        observed = Observation()
        self._counts.append(_Count(name, observed, since=reason))
        return df.observe(observed, F.count(F.lit(1)).alias("all"))

    def rows(self, wait_seconds: float = 60.0) -> list[tuple]:
        """``(input, step, reason, rows)``: what was read, lost for each reason in order, and kept. They add up.

        An input that the optimizer found no need to read (an empty cohort) has NULL counts.
        """
        out, inputs = [], list(dict.fromkeys(c.input for c in self._counts))
        for name in inputs:
            left, steps = None, []
            for i, count in enumerate(c for c in self._counts if c.input == name):
                found = _result(count.observed, wait_seconds)
                here = found.get("all")
                if i == 0:
                    steps.append((READ, here))
                elif count.since is not None:
                    steps.append((count.since, None if here is None or left is None else left - here))
                left = here
                for k, reason in enumerate(count.reasons):
                    lost = found.get(f"r{k}")
                    steps.append((reason, lost))
                    left = None if left is None or lost is None else left - lost
            steps.append((KEPT, left))
            out += [(name, i, reason, n) for i, (reason, n) in enumerate(steps)]
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """``rows`` as a table; its size is that of the plan's text, not of the data."""
        return session.literal_table(spark, self.rows(), SCHEMA)


def _result(observed: Observation, wait_seconds: float) -> dict:
    """The metrics of an observation, or nothing if no job reports them in time."""
    box: dict = {}
    worker = threading.Thread(target=lambda: box.update(observed.get), daemon=True)
    worker.start()
    worker.join(wait_seconds)
    return box
