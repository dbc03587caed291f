"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage.  Each operator is a
module of its own; ``queries`` registers them.  The functions that run inside
tasks are shipped by value, so executors need the third-party libraries but
not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
