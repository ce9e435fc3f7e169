"""Operators for building language-model training data; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors as they are, so that nothing needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
