"""cohortframe: survival-data preparation from raw event tables, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# What runs in Python workers travels with the task, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
