"""Training-data operators: deduplication, filtering, mixing, sharding, packing and search.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and ``corpus_pipeline.py`` chains five of its operators.

Functions of this subpackage travel to the executors by value, so executors
need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
