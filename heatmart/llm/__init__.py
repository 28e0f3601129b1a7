"""Operators for text corpora: deduplication, scoring, extraction, packing, encoding.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
