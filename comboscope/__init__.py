"""Retail basket, demand, pricing and survey analytics as composable Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

# The few task-side Python helpers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
