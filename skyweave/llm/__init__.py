"""Operators for preparing training data. Nothing outside this folder imports them.

Functions that run in Python workers are sent there whole, so executors need no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
