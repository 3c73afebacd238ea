"""quarry: table-level data mining on Spark DataFrames.

Prepare a case table, fit a model, inspect it as DataFrames, score and
explain rows, evaluate the result.  Every heavy step is a Spark job
(aggregates, joins, windows, Spark ML, grouped pandas functions on
bounded groups); the driver only ever holds model-sized state.

Functions of this package that run in Python workers travel with the task
by value, so executors need no copy of the package on their import path.
"""

import sys

from pyspark import cloudpickle

from quarry.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])
