"""Operators for training data: scoring, filtering, near duplicates, formatting, mixing, packing.

Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# What runs in Python workers travels with the query, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
