"""Training-data operators: archives, fingerprints, mixing, tokens, search, dedup, models.

Nothing else in the library imports this subpackage; it may be deleted whole.
Functions of its modules are pickled by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
