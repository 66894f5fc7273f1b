"""Operators for large training-corpus pipelines. Nothing outside this subpackage imports it.

Its functions travel to the executors by value, so that they need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
