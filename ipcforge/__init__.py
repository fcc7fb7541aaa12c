"""ipcforge: a Spark-native engine for classification-code training data.

Reads monthly bulletin archives and ranked code suggestions, normalizes
classification codes, builds the wide and long training tables, splits by
month, trains and evaluates gradient-boosted candidates and keeps a model
registry, all as DataFrame plans.
"""

__version__ = "0.1.0"

# The few Python functions that run inside tasks (XML parsing, archive
# reading) are shipped with the job by value, so executors need not have
# this package on their import path (no --py-files step for a local checkout).
import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
