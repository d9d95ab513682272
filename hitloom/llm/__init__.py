"""Operators for training-data corpora: language, duplicates, mixing, archives, tokens.

Each module holds one operator with a general interface; :mod:`hitloom.llm.queries` applies them to
the given tables. Nothing outside this package imports it.
"""

from pyspark import cloudpickle

import hitloom

# Functions of this package go to the executors with the tasks that call them, so a cluster needs no
# copy of the package.
cloudpickle.register_pickle_by_value(hitloom)
