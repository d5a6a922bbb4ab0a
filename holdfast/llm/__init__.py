"""Operators for preparing training text and vectors.  Nothing else in the library imports this.

Functions that run in Python workers are pickled whole, so executors need NumPy, Arrow and the
tokenizer libraries, but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
