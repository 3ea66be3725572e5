"""Daily-bar analytics as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Executors get the functions with their tasks and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
