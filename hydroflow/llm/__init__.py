"""Operators of a training-data pipeline over documents, pages and conversations.

Functions of this package travel to the tasks by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
