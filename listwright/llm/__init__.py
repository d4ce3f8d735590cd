"""Operations of a training-data pipeline over ``documents``-like tables.

Functions of this package that run in Python workers travel with their task,
so executors need no copy of it.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
