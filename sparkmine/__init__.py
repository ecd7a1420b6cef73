"""PySpark-native analytics and data mining: relational statistics, text mining,
regression, classification, evaluation, time series and streaming jobs."""

import sys

from pyspark import cloudpickle

from sparkmine.session import get_spark

# Functions sent to executors travel by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark"]
