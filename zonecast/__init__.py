"""zonecast: hourly zone-demand analytics as plain Spark DataFrame jobs.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
small driver-side value where the operator is a scalar by nature) and is
built from built-in Spark SQL expressions, windows, joins and Spark ML.

Layout
------
``functions``  column-expression builders (time, metrics, status bands)
``sources``    readers, the driver-table views and sinks
``operators``  relational operators (quality, mart, features, folds, ...)
``plans``      multi-operator jobs (build, backtests, models, monitoring)
``streaming``  incremental version of the hourly mart
"""

__version__ = "0.1.0"
