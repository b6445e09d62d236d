"""Operators for preparing training text, one module per operator.

Nothing else in the library imports this package.  Its functions run inside
Spark's Python workers; they are pickled by value, so executors need no copy
of the package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
