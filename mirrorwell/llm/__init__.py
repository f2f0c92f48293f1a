"""Operators for preparing training data. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel by value, so executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
