"""Operators of a training-data pipeline; nothing outside this package imports it."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks receive these functions with the job, so workers need not have the package installed.
register_pickle_by_value(sys.modules[__name__])
