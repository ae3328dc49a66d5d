"""Product-review sentiment analytics as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the query, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
