"""Streams. State processors go to Python workers by value: these need no copy of the package on their path."""

from pyspark import cloudpickle

import ballast

cloudpickle.register_pickle_by_value(ballast)
