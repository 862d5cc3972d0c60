"""herdcast: herd parasite-count conforming, features, models and forecasts on Spark."""

import os
import sys

# The matrices here are small; a pool of threads per process would only compete with tasks.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

from pyspark import cloudpickle  # noqa: E402

# The few functions that run inside tasks travel with them, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
