"""quillspark: corpus curation, retrieval and training-data operators for PySpark."""

import sys

from pyspark import cloudpickle

# Functions of this package that run on executors travel by value, so that a
# cluster needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
