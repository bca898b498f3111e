"""Operators of a training-data pipeline. Nothing outside this folder (but the entry module) imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so Python workers need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
