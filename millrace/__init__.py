"""Corpus preparation, run-log analytics and sensor/annotation processing on Spark.

Every operator is a ``DataFrame -> DataFrame`` function; the sub-packages are

``functions``  column expressions (text, logs, arrays, images, hashing)
``plans``      skew-safe plan shapes shared by the operators
``operators``  the operators themselves, by family
``sources``    scans and sinks
``streaming``  Structured Streaming jobs
``catalog``    the registered queries and their DuckDB equivalents
"""

import sys

from pyspark import cloudpickle

from millrace.session import build_session, load_table, scratch_path

# Functions sent to Python workers travel whole, so that the workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "load_table", "scratch_path"]
