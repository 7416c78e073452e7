"""Batch operators for research-literature and omics-result tables on Spark."""

import sys

from pyspark import cloudpickle

# Python workers need not have this package on their path: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
