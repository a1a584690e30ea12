"""Operators for training-data pipelines. Nothing outside this package imports it.

Functions of this package travel to Python workers by value, so a cluster need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
