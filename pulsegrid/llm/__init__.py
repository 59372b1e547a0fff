"""Operators of a large-scale training-data pipeline. Nothing else in the package imports this subpackage.

Its functions travel to the executors by value, so a cluster needs no copy of
the package on the workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
