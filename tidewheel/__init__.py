"""DataFrame operators, load jobs and ready-made reports for Spark on plain Parquet."""

import sys

from pyspark import cloudpickle

# Python tasks get the package's functions by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
