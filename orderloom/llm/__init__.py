"""Operators of a training-data pipeline over texts, pages, conversations and embeddings."""

import sys

from pyspark import cloudpickle

# Ship the task functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
