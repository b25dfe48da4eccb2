"""Operators that prepare text corpora for language-model training.

Nothing else in the library imports this subpackage.  Its functions run inside Python workers, which may not
have the repository on their path, so they are shipped by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
