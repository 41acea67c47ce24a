"""Operators of a training-data pipeline.  Nothing else in the library imports this part.

Functions sent to Python workers travel by value, so workers need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
