"""sluice — schema-validated event ingestion on Spark.

Every operator is a plain function from DataFrame(s) to DataFrame, usable on
batch and streaming frames alike.  See README.md for the module map.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
