"""Operators for large text corpora: cleaning, near duplicates, mixing, archives and search.

Nothing else in the library imports this package. Each module holds one operator with a general
interface; ``queries`` applies all of them to the test tables.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent along with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
