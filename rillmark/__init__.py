"""Stream-processing and event-log operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the tasks by value, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
