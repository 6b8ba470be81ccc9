"""Operators for building training corpora; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that
# those need Spark, numpy, pandas and Arrow, but no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
