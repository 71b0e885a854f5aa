"""Operations of a training-data pipeline over a table of documents.

The functions that run on executors are sent by value, so that workers need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
