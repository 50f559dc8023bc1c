"""Operators for preparing training data at scale, one module per operator."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this subpackage with their code, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
