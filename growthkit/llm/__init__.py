"""Operators for training-data pipelines, over documents, pages, vectors and conversations.

Nothing else in the library imports this package. Its functions travel to the Python
workers by value, so that workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
