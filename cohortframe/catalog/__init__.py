"""The checkable queries: each runs library operators on the test tables; most have an SQL equivalent."""

from cohortframe.catalog.base import ORACLES, QUERIES
from cohortframe.catalog import (  # noqa: F401
    codes, cohorts, curves, datasets, files, losses, series, statics, summary, tensors, texts,
)

__all__ = ["ORACLES", "QUERIES"]
