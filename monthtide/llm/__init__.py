"""Operators for pipelines of training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions sent to executors take their code along, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
