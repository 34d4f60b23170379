"""Spark-native news intelligence: DataFrame-to-DataFrame operators."""

import sys

from pyspark import cloudpickle

from newsight.session import clear_scratch, materialise

# the few functions that run in Python workers travel with their job, so executors
# need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["clear_scratch", "materialise"]
