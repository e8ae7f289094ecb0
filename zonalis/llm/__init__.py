"""Training-data operators.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with the tasks, installed there or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
