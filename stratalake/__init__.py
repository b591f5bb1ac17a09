"""Layered lakehouse jobs written as plain DataFrame functions."""

import sys

from pyspark import cloudpickle

# Python tasks carry the package's code with them, so executors need no copy on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
