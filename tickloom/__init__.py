"""tickloom: market-bar analytics expressed as Spark DataFrame plans."""
import sys

from pyspark import cloudpickle

# functions that run in Python workers are shipped by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
