"""Training-data operators: one module per operator, ``queries`` registers them.

Functions of this subpackage run inside Python workers; they travel by value, so that executors
need no copy of the package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
