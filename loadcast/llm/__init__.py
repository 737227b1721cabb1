"""Operators for building language-model training data (nothing else in the library imports this).

The functions that run in Python workers travel with their tasks, so executors
need numpy, pyarrow and tokenizers but not this package.
"""

import sys

from pyspark.cloudpickle import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
