"""Operators for building training data from a crawl. Nothing else in the library imports
this subpackage; the entry file adds its queries only where it can be imported."""

import sys

from pyspark import cloudpickle

# Worker code travels by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
