"""Transaction analytics on Spark: ingest, quality, KPIs, baskets, RFM, churn and forecasts."""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run on executors travel with their code, so executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
