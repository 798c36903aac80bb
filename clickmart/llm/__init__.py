"""Operators of a training-data pipeline: one module per operator, queries and SQL twins beside them.

Nothing outside this folder imports it. Functions that run in Spark's Python workers travel by value, so a
worker needs numpy and pyarrow but not this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
