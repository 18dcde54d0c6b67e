"""Spark-native preparation of sequencing reads, sample sheets and quality-exam datasets."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
