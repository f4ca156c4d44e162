"""Operators of a training-data pipeline: packing, de-duplication, sharding, scans, codecs, search.

Each module holds one operator with a general interface; ``queries`` applies
every operator to its whole table.  Nothing outside this package imports it.
Functions sent to executors are pickled by value, so executors need only the
third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
