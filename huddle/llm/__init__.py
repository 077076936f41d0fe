"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own interface; ``queries`` registers
one thin query per operator and ``oracle`` the matching SQL.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel by value, so executors need only
# the public libraries, not an installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
