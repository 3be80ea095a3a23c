"""Spark DataFrame operators for yearly panel data about entities that carry
many numeric attributes and arrive from several imperfect sources."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan, so that the executors need
# no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
