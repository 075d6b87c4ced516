"""Operators for training-data pipelines; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel with the query, so executors need no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
