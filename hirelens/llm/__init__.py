"""Training-data operators: search, near-duplicates, extraction, filters,
tokenisation, classifiers, packing and scans, each as a Spark job.

Functions shipped to executors are pickled by value, so a job does not need
the package installed on every machine.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
