"""Operators for training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# What runs in Python workers travels with the task, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from cohortframe.llm.base import ORACLES, QUERIES  # noqa: E402
from cohortframe.llm import (  # noqa: E402, F401
    chat_format, exact_dedup, filter_audit, language_id, license_scan, line_dedup, mixing, near_dedup, packing, quality,
    substring_dedup, token_counts, whitening,
)

__all__ = ["ORACLES", "QUERIES"]
