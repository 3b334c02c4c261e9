"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import arrearscope
from pyspark import cloudpickle

# Functions go to the executors with their code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(arrearscope)
