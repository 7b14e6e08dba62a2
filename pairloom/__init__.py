"""Pairloom: instruction-tuning data preparation and generation scoring on Spark.

Every public operator is a function from DataFrame to DataFrame.
"""

import sys

from pyspark import cloudpickle

# Arrow functions are sent to executors by value, so a cluster does not need
# the package installed on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
