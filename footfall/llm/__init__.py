"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks with their code, so that the
# package need not be installed where the executors run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
