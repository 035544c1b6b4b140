"""relearn: periodic retraining and champion/challenger comparison on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, windows, joins and aggregations, so Catalyst plans the work and
the same code runs on ``local[*]`` and on a large cluster.  Only the job layer
(``relearn.plans.jobs``) triggers writes.
"""

__version__ = "0.1.0"

import sys as _sys

try:  # ship this package's functions to Python workers by value, so pandas
    # UDFs work even where the package is not installed on the executors.
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark
    pass
