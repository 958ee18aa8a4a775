"""motifspark: find more sequence fragments like a few known ones, on Spark.

Every public function takes and returns Spark DataFrames; seeded choices are
md5-keyed so that they do not depend on partitioning.
"""

import sys as _sys

__version__ = "0.1.0"

# Ship our own functions to Python workers by value, so executors need no
# installed copy of this package (Arrow kernels are nested closures that call
# module-level helpers).
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
