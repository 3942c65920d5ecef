"""Operators for large training-data corpora (documents and web pages).

One module per operator, each a ``DataFrame -> DataFrame`` function with its
own parameters; ``queries`` registers one query per operator.  Nothing else in
the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel by value, so the
# executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
