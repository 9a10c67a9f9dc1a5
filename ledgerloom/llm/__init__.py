"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so executors need not
# have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
