"""Sharded, retained event logs as Spark tables and streams."""

import sys

from pyspark import cloudpickle

# Sources, processors and functions sent to workers carry their code along, so the workers
# that plan a source or set up a state processor need the package on no path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
