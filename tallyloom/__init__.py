"""Retail recommendation analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry the package's code with them, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
