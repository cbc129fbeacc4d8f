"""Operators for building language-model training corpora.

Every operator is a function over Spark DataFrames; per-document Python runs
in Arrow batches inside Spark tasks. Nothing else in the library imports this
package.

Code that runs in Python workers is shipped by value, so executors need no
installed copy of the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
