"""hitloom: song-chart analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
