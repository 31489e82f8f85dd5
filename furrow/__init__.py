"""furrow: document-facet analytics expressed as Spark DataFrame plans."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so workers need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
