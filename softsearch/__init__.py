"""softsearch: semantic search over text collections, expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

from softsearch.config import Defaults, build_session, shared_dir

# Functions that run in Python workers travel with their code, so the executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Defaults", "build_session", "shared_dir"]
