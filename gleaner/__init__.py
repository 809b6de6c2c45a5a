"""Crawled pages to clean job postings, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python steps carry the package's own functions with them, so executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
