"""Training-data operators: archives, quality, decontamination, dedup, mixing, token files, chat, secrets.

Functions of this package that run in tasks travel with them, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
