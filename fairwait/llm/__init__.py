"""Operators for preparing training data, their registered queries and the SQL that states them."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's functions with them, so that workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
