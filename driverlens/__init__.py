"""Streaming-progress analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its task-side helpers travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
