"""Spark-native concept-graph and data-processing engine."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel with the tasks, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
