"""Operators for preparing language-model training data, one module each.

Tasks get the code of this subpackage along with their function, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
