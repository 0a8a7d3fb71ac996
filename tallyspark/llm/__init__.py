"""Training-data operators: quality, deduplication, decontamination, privacy, tokenizing, scoring, sharding.

Nothing else in the library imports this subpackage. ``queries.py`` holds the thin registered queries.
Functions that run in Python workers travel by value, so executors need no installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
