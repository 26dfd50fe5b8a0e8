"""filingloom: Spark-native document discovery and extraction analytics."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel by value, so executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
