"""cohortlens: cohort and clinical-event analytics expressed as Spark DataFrame plans.

Every operator takes DataFrames and returns DataFrames; nothing is collected to the
driver.  Sub-packages:

* ``sources``    readers, sinks and the adapters that map the driver tables onto
                 the event / mortality / graph shapes.
* ``functions``  Column-level helpers (hash splits, code roll-up, svmlight text).
* ``operators``  the analytic operators (cohort split, statistics, features,
                 phenotype, sequences, graph, metrics, ML).
* ``plans``      registered queries and their DuckDB oracle SQL.
* ``streaming``  Structured Streaming k-means.
"""

__version__ = "0.1.0"

# Functions of this package that run inside tasks (pandas kernels, small UDF helpers) are
# pickled by value, so executors never need the package installed or on their path.
try:  # pragma: no cover - depends on the PySpark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
