"""Operators for building training data from large document tables."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their tasks; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
