"""Operators for preparing training text. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their jobs, so the workers need
# no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
