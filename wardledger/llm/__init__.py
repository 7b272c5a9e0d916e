"""Operators for preparing training data: one module each, and ``entry`` with their queries.

Nothing else in the library imports this subpackage. Functions that run in Python
tasks are sent to the executors by value, so they need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
