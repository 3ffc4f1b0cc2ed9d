"""Operators for preparing training corpora: filters, duplicate removal, decontamination, tokens, search.

Functions of this package travel to the executors by value, so they need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
