"""Operators for training data: filters, duplicates, packing, shards, tokens, pages.

Their functions travel to the tasks by value, so executors need Spark and the libraries
used, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
