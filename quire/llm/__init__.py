"""Operators for large text corpora: decontamination, chat format, duplicates, search, token files, mixing, licences, toxicity."""

import sys

from pyspark import cloudpickle

# Python tasks carry their functions with them, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
