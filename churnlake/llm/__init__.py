"""Operators that prepare a training corpus, and their queries.

Functions that run in tasks travel with the job, so the executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
