"""Training-data operators: deduplication, tokenising, packing, search, language and secrets.

Nothing else in the library imports this package. Functions that run in Python workers are pickled
by value, so a worker needs numpy, pyarrow and the public libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
