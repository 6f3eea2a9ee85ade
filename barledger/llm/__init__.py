"""Operators for large training-data corpora; nothing else in the library imports them."""

from pyspark import cloudpickle

import barledger

# Functions go to the workers by value, so a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(barledger)
