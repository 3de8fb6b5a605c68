"""Operators of a training-data pipeline over document, page and label tables.

Nothing else in the library imports this package; ``queries`` registers one query per
operator. Every operator takes DataFrames and returns DataFrames, reads only the columns
it names and leaves whatever else the input carries alone.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel whole, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
