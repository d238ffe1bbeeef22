"""Analysis and forecasting of many time series with Spark DataFrames.

Frames are in long form: ``k`` (series key), ``t`` (timestamp without zone), ``v`` (double,
nullable).  An indexed frame also carries ``i``, the row number inside the series, and ``chunk``,
``i`` divided by a fixed row count, so that no task ever has to hold a whole series.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
