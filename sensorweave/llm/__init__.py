"""Operators for preparing large text corpora (training-data pipelines)."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Task functions travel with their code, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
