"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors need not have the library installed: the functions of this package travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
