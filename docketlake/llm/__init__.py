"""Operators and queries for preparing training data from a table of documents.

Nothing else in the library imports this package. Its functions travel to the tasks by
value, so workers need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
