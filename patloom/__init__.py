"""Patent publication analytics on Spark.

Weekly archives, nested or flat, become rows; rows become typed records; records are filtered,
deduplicated, inserted, normalised, chunked, embedded and pooled, in batch or as a stream.
"""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
