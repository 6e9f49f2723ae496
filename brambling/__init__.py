"""brambling: a Spark-first engine for bibliographic records and text corpora.

Functions that run in Python workers are pickled by value, so executors need no copy of the package on their path.
"""

from pyspark import cloudpickle

import brambling as _self

cloudpickle.register_pickle_by_value(_self)
