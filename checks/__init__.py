"""Queries over the test tables, and the same results written in plain SQL."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
