"""folio: document analytics and corpus preparation on Spark DataFrames.

Executors get its functions by value, so that they need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
