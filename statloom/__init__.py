"""Statistics and model building on Spark DataFrames.

Plain functions that take a DataFrame and return a DataFrame, a column, or a small fitted
model whose parameters become literals in a column expression.
"""

import sys

from pyspark import cloudpickle

# task functions travel inside the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
