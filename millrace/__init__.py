"""Feature, statistics and experiment work on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that tasks run travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from millrace.session import get_spark, shared_dir  # noqa: E402

__all__ = ["get_spark", "shared_dir"]
