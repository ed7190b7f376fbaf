"""Operators that prepare training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel by value: executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
