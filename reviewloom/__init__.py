"""Spark-first moderation of free-text reviews: prepare, sample, augment, train, score and audit."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions of this package travel to the executors by value, so a job needs no --py-files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
