"""regloom: Spark-native tabular regression pipeline - cleaning, profiling,
hash splits, RBF / ANFIS / fuzzy-c-means / MLP regressors trained as Spark
aggregations, metrics and report tables."""

import sys as _sys

try:  # ship task closures by value, so executors need no installed copy of the package
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001  older cloudpickle: fall back to spark.submit.pyFiles
    pass
