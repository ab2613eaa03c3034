"""Korbwerk: listing aggregation and analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python workers get our functions with each task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
