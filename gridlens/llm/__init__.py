"""Operators for preparing training data at scale. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so executors need no copy of this folder on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
