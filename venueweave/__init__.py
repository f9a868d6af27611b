"""venueweave: entity catalogue and training-data operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value: nothing has to be installed or shipped there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
