"""Operators for preparing training text."""

import sys

from pyspark import cloudpickle

# Functions for the executors travel with the code they call, so that a job runs
# where the package isn't installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
