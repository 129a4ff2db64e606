"""Operators of a training-data pipeline, as Spark jobs.

The functions that run in Python workers travel with the job (pickled by
value), so executors need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
