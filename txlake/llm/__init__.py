"""Operators for preparing text corpora. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of these modules that run on executors travel with the job, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
