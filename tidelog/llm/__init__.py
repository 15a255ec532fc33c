"""Operators for building training corpora: search, filtering, deduplication, tokens.

Nothing else in the library imports this subpackage. ``queries`` holds the registered
queries and ``oracles`` their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
