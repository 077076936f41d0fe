"""Operators: DataFrame functions parameterised by column names.

Functions that run inside tasks travel by value, so executors need only the
public libraries, not an installed copy of this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
