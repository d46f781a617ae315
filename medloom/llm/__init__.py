"""Operators of a pipeline for training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers whole, so that these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
