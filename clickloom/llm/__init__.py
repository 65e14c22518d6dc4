"""Operators for preparing training data: dedup, mixing, filtering, search, encoding.

Nothing else in the library imports this package; it imports general helpers only.
"""

import sys

from pyspark import cloudpickle

# Functions go to the executors whole, so a session needs no files shipped to them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
