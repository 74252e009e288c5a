"""sonara: signal catalogs, sample series and mel spectrograms as Spark DataFrames.

Every operator is a function ``DataFrame (+ parameters) -> DataFrame`` so that
``df.transform(op)`` composes; the heavy lifting is left to Catalyst and Tungsten.
"""

__version__ = "0.1.0"

import sys as _sys

try:  # ship our helpers to Python workers by value: no --py-files needed on a cluster
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - pyspark missing or API changed
    pass
