"""Operators of a training-data pipeline, one module each.

Functions that run inside Python workers are pickled by value, so executors
need pyspark, numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
