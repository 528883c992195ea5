"""Rivulet: keyed-record processing expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python functions that run inside tasks travel with the plan, so executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
