"""Streaming jobs. Their processors travel to the executors by value, so a cluster
needs no copy of this package in its Python path."""

from pyspark import cloudpickle

import tallyguard

cloudpickle.register_pickle_by_value(tallyguard)
