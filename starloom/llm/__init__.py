"""Operators for preparing training text, one module per operator.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds the
queries of ``starloom.llm.queries`` when the folder is present.
"""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to executors by value, so that workers need
# no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
