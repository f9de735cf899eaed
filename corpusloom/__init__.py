"""Corpus preparation and training-run analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from corpusloom.config import Settings, SpecialTokens

__all__ = ["Settings", "SpecialTokens"]

# Functions of this package travel to Python tasks with their code, so that tasks run
# whether or not the package is installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
