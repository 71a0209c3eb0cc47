"""cartwheel — storefront clickstream analytics on Spark.

Every computation is a DataFrame -> DataFrame transform; the same transform
runs in batch over whole tables and inside Structured Streaming queries.
"""

import sys

from pyspark import cloudpickle

from cartwheel.params import HARNESS, REFERENCE, Params

__all__ = ["Params", "REFERENCE", "HARNESS"]

# Functions sent to Python workers carry their code with them, so executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
