"""Operators a training-data pipeline needs; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get these functions and the models in their closures by value, so workers need no copy of
# the package on their path. Broadcast variables would be pickled by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
