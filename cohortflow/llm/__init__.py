"""Operators for preparing language-model training data. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, whether or not the workers have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
