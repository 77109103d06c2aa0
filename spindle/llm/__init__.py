"""Operators of a training-data pipeline over the ``documents``, ``embeddings`` and ``conversations`` tables.

Nothing else in the library imports this subpackage.  Its functions are shipped to executors by value, so workers need
only numpy, pyarrow, xxhash, tokenizers and tiktoken, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
