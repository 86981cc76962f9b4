"""sievestone: a Spark-first engine for curating, auditing and splitting labelled data."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Python workers receive the package's functions by value, so a job runs on executors on which the
# package is not installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
