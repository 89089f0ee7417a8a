"""sluice: declarative monitoring rules over event data, compiled to Spark DataFrames."""

import sys

from pyspark import cloudpickle

#: Functions sent to executors travel with their code, so the package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
