"""Exposure analytics on Spark."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: its functions travel with the plans that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
