"""Web-address extraction, cleaning and evaluation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from streetloom.session import configure, scratch_path

# The few Python functions of this package travel to the executors by value, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure", "scratch_path"]
