"""Operators for preparing training text at scale: language, quality, duplicates, secrets, chat, tokens, models.

Nothing outside this folder imports it. Functions are pickled by value, so that Python workers need
no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
