"""Operators of a training-data pipeline: deduplication, packing, classification, tokens, scoring, search.

Python functions of this package travel to the executors by value, so that
executors need the public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
