"""Operators that prepare text corpora for training. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: nothing is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
