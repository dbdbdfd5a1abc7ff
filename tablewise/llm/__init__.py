"""Operators for preparing text corpora as training data.

Each module is one operator with a general DataFrame interface; ``queries`` registers one
thin ``opN_<name>`` query per operator.  Nothing else in the library imports this package.

Functions that run in Python workers are pickled by value, so workers need the third-party
libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
