"""Operators of a training-data pipeline on Spark DataFrames.

Functions that run inside Python tasks are pickled by value, so executors need the third-party
libraries only, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
