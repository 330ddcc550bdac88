"""linkloom: enrich and link tables of short multilingual records with Spark.

Every public operator takes and returns Spark ``DataFrame`` or ``Column``
objects and stays lazy unless its docstring says otherwise.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers travel with the job, so the
# package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
