"""Operators for preparing large text corpora: rules, classifiers, near-duplicates, archives,
mixing and sharding. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, which need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
