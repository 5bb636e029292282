"""parley: support-conversation analytics as Spark DataFrame operators.

Every public operator takes DataFrames / Columns and returns a DataFrame or a
Column, so Catalyst sees one declarative plan per job.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of the package travel to the executors by value, so that a cluster needs no
# installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
