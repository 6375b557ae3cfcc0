"""Operators for building language-model training corpora.

Nothing else in the package imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.  Its functions travel to the executors by
value, so a job needs no copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
