"""Table jobs for PySpark: plain functions that take and return DataFrames."""

import sys

from pyspark import cloudpickle

# Python workers get the code that runs inside tasks together with the task,
# so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
