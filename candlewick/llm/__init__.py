"""Operators for preparing language-model training data.

Nothing outside this package imports it.  Task functions are shipped by value,
so executors need no copy of the package on their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
