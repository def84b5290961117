"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so executors need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
