"""Operators of a training-data pipeline. Nothing else in the library imports
this subpackage; its queries are registered by ``__spark_entry__`` only.

Functions of this subpackage travel to the executors by value, so that the
executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
