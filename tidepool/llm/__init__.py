"""Training-data operators.  Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need this folder neither installed nor on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
