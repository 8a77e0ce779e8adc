"""Spark-native analytics for sales that arrive per entity, item and week."""

import sys

from pyspark import cloudpickle

from .config import Keys
from .plans.settings import Config, load_config

# Functions and settings shipped to Python workers travel by value: executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Config", "Keys", "load_config"]
