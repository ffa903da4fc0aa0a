"""Operators for building training data: packing, tokens, quality, search, scoring, chat, pages, copies and secrets.

Nothing else in the library imports this package. Its functions travel to the executors by value, so workers
need no copy of the repository.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
