"""weftline: entity analytics and data preparation as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Kernels travel to the Python workers by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
