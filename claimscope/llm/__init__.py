"""Operators of a training-data pipeline: near and exact dedup, secrets, search, toxicity, mixing, chat, lines, packing, sharding."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
