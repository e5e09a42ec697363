"""Operators of a training-data pipeline over documents and web pages."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value: they need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
