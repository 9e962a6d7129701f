"""Operators for preparing training text: mixing, dedup, classification, scanning,
packing and search. Nothing else in the library imports this subpackage.

Functions that run in Python workers are shipped by value, so executors need not
have the library installed and jobs may start from any working folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
