"""Tabular risk analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
