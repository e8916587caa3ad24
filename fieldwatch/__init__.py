"""Fieldwatch: pollution monitoring over many sites, written for Spark.

Readings arrive as JSON on a topic or in files. The package rolls them up
into hourly and daily means, raises orange and red alerts through
interchangeable detectors, and forecasts the pollution category ahead.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel whole, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
