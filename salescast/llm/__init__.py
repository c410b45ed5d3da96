"""Operators of a training-data pipeline, each in a module of its own."""

import sys

from pyspark import cloudpickle

# executors get the functions of this package with the job, not by import
cloudpickle.register_pickle_by_value(sys.modules[__name__])
