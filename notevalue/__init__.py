"""Spark jobs over tables of priced reviews: curate, fit, score, retrieve, scan."""

import sys

from pyspark import cloudpickle

# The few small functions that run inside Python workers travel with the job, so that workers need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
