"""Event operators as plain functions on Spark DataFrames and streams."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Send the package's functions and classes to Python workers by value, so that workers
# without the package on their path can run them, those beside the driver included.
register_pickle_by_value(sys.modules[__name__])
