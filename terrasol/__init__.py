"""terrasol: Spark-native land-use and document analytics.

Every public operator is a pure function ``DataFrame -> DataFrame`` or
``Column -> Column``; nothing is collected to the driver.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# Ship our Python functions (pandas UDFs, mapInPandas bodies) by value: executors
# need pyspark, numpy and pandas but not this package on their path.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from terrasol.session import get_session, checkpoint_dir  # noqa: E402

__all__ = ["get_session", "checkpoint_dir"]
