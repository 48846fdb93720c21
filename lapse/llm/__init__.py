"""Operators for preparing training data (deduplication, search, mixing, packing, ...).

Nothing else in the library imports this package. Functions of this package
that run inside tasks travel with the tasks, so executors need numpy, pyarrow
and the like, but not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
