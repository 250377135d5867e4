"""reelrank: recommendation analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames and keyword parameters to a
DataFrame; reading and writing live in ``sources``, shuffle layout in ``plans``.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers travel with their task, so executors need
# only NumPy and PyArrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
