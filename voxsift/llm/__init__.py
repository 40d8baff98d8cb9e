"""Operators for large training-data pipelines.

One module per operator, ``registry`` with the registered queries and their
SQL twins.  Nothing else in the library imports this subpackage.

The functions that run inside tasks are pickled by value, so executors need
no copy of the package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
