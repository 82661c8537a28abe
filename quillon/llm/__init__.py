"""Operators for large-scale training-data pipelines.

Functions that run in Python workers are sent by value, so that executors need
the public packages that they use, but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
