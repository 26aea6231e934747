"""Layered batch lakehouse analytics as plain Spark DataFrame plans.

Every operator takes DataFrames and column names and returns a DataFrame, so
calls chain with ``df.transform(...)``.
"""

import sys

from pyspark import cloudpickle

# The few helpers that run inside Python workers travel by value, so executors
# do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
