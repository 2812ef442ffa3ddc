"""Composable DataFrame operators for analytics jobs on Spark."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the workers with the query, so it
# need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
