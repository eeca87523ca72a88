"""Corpus curation and training-data preparation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Ship the package's Python helpers inside the task closure, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
