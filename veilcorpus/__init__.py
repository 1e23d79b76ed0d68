"""veilcorpus: prepare and evaluate corpora labelled with sensitive entities, on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Function bodies travel with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
