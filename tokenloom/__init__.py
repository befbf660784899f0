"""Corpus preparation, vocabularies and next-token statistics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
