"""Operators of a training-data pipeline, one module each, over tables of documents.

Nothing else in the library imports this package. Worker functions are pickled by value, so
executors need pyarrow and numpy but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
