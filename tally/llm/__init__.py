"""Operators of a training-data pipeline: dedup, privacy, extraction, search, scoring, mixing, packing.

Each module holds one operator with its own interface; ``queries`` registers
the fixed-contract queries over the test tables. Nothing else in the library
imports this package.
"""

import sys

from pyspark import cloudpickle

# tasks get this package's functions by value, so executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])
