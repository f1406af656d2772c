"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  ``queries.py`` holds the
registered queries; each operator module has its own general interface.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions themselves, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
