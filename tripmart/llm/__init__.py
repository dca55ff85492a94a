"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Task code travels with a job, so executors need Spark's own Python packages only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
