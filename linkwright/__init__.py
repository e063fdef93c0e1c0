"""linkwright: record linkage and table processing as Spark DataFrame plans."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry this package's code along: it needn't be installed there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
