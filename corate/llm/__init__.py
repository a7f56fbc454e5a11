"""Operators for preparing large text corpora (quality, dedup, mixing, ...).

Nothing else in the library imports this subpackage; ``__spark_entry__``
adds its queries when it can be imported.

Functions that run in Python workers are pickled by value, so executors need
no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
