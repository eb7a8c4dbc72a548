"""plumbline: tabular data-quality work expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Ship the package's functions with the tasks, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
