"""Training-data operators; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions sent to the executors carry their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
