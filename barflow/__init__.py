"""Market time-series analytics expressed as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# The small functions that run in Python workers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
