"""Analytics on Spark: valuation of entities from recorded performance, and preparation of training text."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers with the task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from valora.session import get_session, scratch_dir  # noqa: E402

__all__ = ["get_session", "scratch_dir"]
