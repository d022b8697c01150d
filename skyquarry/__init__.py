"""Sky-map analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Kernels reach executors by value, so that workers need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
