"""Operators of a training-data pipeline; nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
