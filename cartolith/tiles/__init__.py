"""Tiles: filters, vector encoding and packaging.

Worker functions and data sources are pickled by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
