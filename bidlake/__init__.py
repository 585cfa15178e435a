"""bidlake: a Spark-native engine for collecting, cleaning and merging
business-opportunity records.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame/SQL API; Python only runs inside Arrow-batched UDFs where Spark
has no built-in (NFKD normalisation, HTML tree flattening, lenient dates).
"""

import sys

from bidlake.settings import JobSettings

# Python helpers (Arrow UDFs, the HTML flattener) travel to the workers by
# value, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package with addPyFile
    pass

__all__ = ["JobSettings"]
