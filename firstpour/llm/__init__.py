"""Operators a training-data pipeline needs, one module each.

Nothing outside this package imports it. Task code travels to the executors by value, so they need
no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
