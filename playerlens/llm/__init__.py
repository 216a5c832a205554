"""Operators for training-data pipelines. Nothing else in the library imports this package.

Functions of the package that run inside tasks travel by value, so executors need no installation.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
