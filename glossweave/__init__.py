"""Table localisation on Spark: cells, text pool, translation memory, batch inference, quality checks."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
