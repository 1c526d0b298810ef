"""Operators for training-data pipelines. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Python workers get these modules with the functions, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
