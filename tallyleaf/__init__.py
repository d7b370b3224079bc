"""Billing analytics and near-duplicate notice matching as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
