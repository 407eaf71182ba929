"""Gristmill: a PySpark-native engine for curating conversational and instruction text."""

import sys

from pyspark import cloudpickle

# Kernels travel with the task, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
