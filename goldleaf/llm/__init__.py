"""Operators for large training-data pipelines; nothing else in the library
imports this subpackage.

Functions of this subpackage that run inside tasks are sent along with the
tasks, so executors need not have the library installed."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
