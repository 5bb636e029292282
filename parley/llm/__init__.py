"""Corpus operators for training data: scoring, search, extraction, mixing, scans,
near-duplicates, tokens. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
